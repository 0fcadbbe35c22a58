"""Queries of the graph, text, chunking, vector and export operators over the given tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.functions import vector
from folioforge.operators import ann, chunking, export, filenames, graph, retrieval, shared_edges
from folioforge.operators.components import connected_components
from folioforge.session import ensure_checkpoint_dir, table
from folioforge.sources import gml

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# ---- tables in the shape the operators take

FIELDS = {"entities": "entity", "keywords": "keyword", "figures": "figure"}
PRIORITY = ("entity", "figure", "keyword")


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """build_graph with each record once: a row loaded again repeats every column but loaded_at."""
    return table(spark, sf, "build_graph").drop("loaded_at").dropDuplicates(["node_id"])


def items(spark: SparkSession, sf: str) -> DataFrame:
    return shared_edges.item_table(table(spark, sf, "build_graph"), "unique_id", FIELDS)


def typed_edges(spark: SparkSession, sf: str) -> DataFrame:
    return shared_edges.aggregate_raw_edges(table(spark, sf, "edges"))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct unordered node pairs of edges without loops."""
    return shared_edges.unordered(table(spark, sf, "edges").select("node1", "node2")).where("src <> dst").distinct()


CHUNKS = "chunks AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY loaded_at) AS rn_ FROM build_graph) WHERE rn_ = 1)"
ITEMS = """items AS (SELECT DISTINCT unique_id AS node, edge_type, item FROM (
  SELECT unique_id, edge_type, regexp_replace(unnest(l), '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g') AS item FROM (
    SELECT unique_id, 'entity' AS edge_type, entities AS l FROM build_graph UNION ALL
    SELECT unique_id, 'keyword', keywords FROM build_graph UNION ALL SELECT unique_id, 'figure', figures FROM build_graph))
  WHERE item <> '' AND unique_id IS NOT NULL)"""
TYPED = """typed AS (SELECT least(node1, node2) AS src, greatest(node1, node2) AS dst, edge_type, count(DISTINCT shared_item) AS weight
  FROM edges WHERE node1 IS NOT NULL AND node2 IS NOT NULL AND edge_type IS NOT NULL AND shared_item <> '' GROUP BY 1, 2, 3)"""
PAIRS = "pairs AS (SELECT DISTINCT least(node1, node2) AS src, greatest(node1, node2) AS dst FROM edges WHERE node1 <> node2)"


# ---- edges from shared items


@query(f"""WITH {ITEMS}, c AS (SELECT edge_type, item FROM items GROUP BY 1, 2 HAVING count(*) BETWEEN 2 AND 10000),
u AS (SELECT i.* FROM items i JOIN c USING (edge_type, item)),
p AS (SELECT a.node AS src, b.node AS dst, a.edge_type, a.item FROM u a JOIN u b ON a.edge_type = b.edge_type AND a.item = b.item AND a.node < b.node)
SELECT src, dst, edge_type, count(*) AS weight, array_to_string(list_sort(list(item))[1:3], '|') AS shared FROM p GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def shared_item_edges(spark, sf):
    out = shared_edges.shared_item_edges(items(spark, sf), min_overlap=2, max_shared=3)
    return out.withColumn("shared", F.array_join("shared", "|"))


@query(f"""WITH {ITEMS} SELECT a.node AS src, b.node AS dst, count(*) AS weight FROM items a JOIN items b ON a.edge_type = b.edge_type AND a.item = b.item AND a.node < b.node GROUP BY 1, 2""")
def semantic_overlap_edges(spark, sf):
    """Every pair of nodes that share an item, with the number of all items they share: no cap and no least weight."""
    return shared_edges.overlap_edges(items(spark, sf))


@query(f"""WITH {ITEMS}, p AS (SELECT a.node AS src, b.node AS dst, a.edge_type, a.item FROM items a JOIN items b ON a.edge_type = b.edge_type AND a.item = b.item AND a.node < b.node)
SELECT src, dst, edge_type, count(*) AS weight, array_to_string(list_sort(list(item))[1:3], '|') AS shared FROM p GROUP BY 1, 2, 3""")
def shared_item_edges_uncapped(spark, sf):
    """Edges of shared items by type, whatever the number of an item's nodes."""
    return shared_edges.shared_item_edges(items(spark, sf), most_nodes=None, separator="|")


@query(f"WITH {ITEMS} SELECT edge_type, item, count(*) AS n_nodes, min(node) AS first_node FROM items GROUP BY 1, 2")
def inverted_index(spark, sf):
    return shared_edges.inverted_index(items(spark, sf))


@query(f"WITH {TYPED} SELECT * FROM typed")
def aggregated_edges(spark, sf):
    return typed_edges(spark, sf)


@query(f"""WITH {TYPED} SELECT src, dst, edge_type, weight FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY
CASE edge_type WHEN 'entity' THEN 1 WHEN 'figure' THEN 2 WHEN 'keyword' THEN 3 ELSE 4 END, edge_type) AS k FROM typed) WHERE k = 1""")
def edge_first_type_wins(spark, sf):
    return shared_edges.one_edge_per_pair(typed_edges(spark, sf), PRIORITY)


@query("""WITH d AS (SELECT node1, node2, edge_type, count(DISTINCT shared_item) AS weight FROM edges
  WHERE edge_type IS NOT NULL AND shared_item <> '' AND node1 IS NOT NULL AND node2 IS NOT NULL GROUP BY 1, 2, 3)
SELECT least(node1, node2) AS src, greatest(node1, node2) AS dst, edge_type, weight, node1 AS from_node, node2 AS to_node FROM
(SELECT *, row_number() OVER (PARTITION BY least(node1, node2), greatest(node1, node2) ORDER BY weight DESC, edge_type, node1) AS k FROM d) WHERE k = 1""")
def edge_max_weight_dedup(spark, sf):
    directed = table(spark, sf, "edges").where("edge_type is not null and shared_item <> ''").select("node1", "node2", "edge_type", "shared_item").distinct()
    directed = directed.groupBy("node1", "node2", "edge_type").agg(F.count(F.lit(1)).alias("weight"))
    return shared_edges.heaviest_edge_per_pair(directed, ["edge_type", "from_node"])


@query("SELECT least(node1, node2) AS src, greatest(node1, node2) AS dst, count(*) AS n FROM edges WHERE node1 IS NOT NULL AND node2 IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_pairs(spark, sf):
    return shared_edges.repeated_pairs(table(spark, sf, "edges"))


@query("""SELECT count(*) AS n_rows, count(*) - count(DISTINCT {'a': node1, 'b': node2, 'c': edge_type, 'd': shared_item}) AS n_repeated,
count(*) FILTER (node1 IS NULL OR node1 = '') + count(*) FILTER (node2 IS NULL OR node2 = '') AS n_missing_ends,
count(*) FILTER (edge_type IS NULL OR edge_type = '') AS n_missing_type, count(*) FILTER (shared_item IS NULL OR shared_item = '') AS n_missing_item,
count(*) FILTER (node1 = node2) AS n_loops FROM edges""")
def quality_counters(spark, sf):
    return export.quality_counts(table(spark, sf, "edges"))


@query("SELECT coalesce(edge_type, 'unknown') AS edge_type, count(*) AS n FROM edges GROUP BY 1")
def type_histogram(spark, sf):
    return table(spark, sf, "edges").groupBy(F.coalesce("edge_type", F.lit("unknown")).alias("edge_type")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CHUNKS}, s AS (SELECT DISTINCT source_file, parent_id, unique_id AS n FROM chunks WHERE source_file IS NOT NULL AND parent_id IS NOT NULL)
SELECT a.n AS src, b.n AS dst, 1.0::DOUBLE AS weight FROM s a JOIN s b ON a.source_file = b.source_file AND a.parent_id = b.parent_id AND a.n < b.n""")
def sibling_edges(spark, sf):
    return shared_edges.sibling_edges(chunks(spark, sf), "unique_id", ["source_file", "parent_id"])


def _mentions(spark, sf):
    rows = chunks(spark, sf).where("source_file is not null").select("source_file", F.col("node_id").alias("seq"), F.explode(tx.trimmed_items(F.col("entities"))).alias("item"))
    return rows.withColumn("item", F.lower("item")).distinct()


MENTIONS = f"""{CHUNKS}, m AS (SELECT DISTINCT source_file, node_id AS seq, lower(item) AS item FROM (SELECT source_file, node_id,
  regexp_replace(unnest(entities), '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g') AS item FROM chunks WHERE source_file IS NOT NULL) WHERE item <> ''),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_file, item ORDER BY seq) AS nth FROM m) WHERE nth >= 2)"""


@query(f"WITH {MENTIONS} SELECT source_file, item, seq, nth FROM g")
def entity_freq_gate(spark, sf):
    return shared_edges.running_gate(_mentions(spark, sf)).withColumn("nth", F.col("nth").cast("bigint"))


@query(f"""WITH {MENTIONS} SELECT a.item AS item_a, b.item AS item_b, count(*) AS weight FROM g a JOIN g b ON a.source_file = b.source_file AND a.seq = b.seq AND a.item < b.item GROUP BY 1, 2""")
def cooccurrence_weights(spark, sf):
    return shared_edges.gated_cooccurrence(_mentions(spark, sf))


@query(f"""WITH {MENTIONS}, ch AS (SELECT DISTINCT parent_id, unique_id FROM chunks WHERE parent_id IS NOT NULL AND unique_id IS NOT NULL)
SELECT parent_id AS source, unique_id AS target, 'has_child' AS relation, 1::BIGINT AS weight FROM ch UNION ALL
SELECT DISTINCT c.unique_id, g.item, 'mentions', 1 FROM g JOIN chunks c ON c.node_id = g.seq WHERE c.unique_id IS NOT NULL UNION ALL
SELECT a.item, b.item, 'co_occurs_with', count(*) FROM g a JOIN g b ON a.source_file = b.source_file AND a.seq = b.seq AND a.item < b.item GROUP BY 1, 2""")
def entity_graph_edges(spark, sf):
    nodes = chunks(spark, sf)
    mentions = _mentions(spark, sf).join(nodes.select(F.col("node_id").alias("seq"), F.col("unique_id").alias("node")), "seq")
    return shared_edges.entity_graph_edges(nodes.select(F.col("unique_id").alias("node"), F.col("parent_id").alias("parent")), mentions)


@query(f"""WITH {CHUNKS}, o AS (SELECT DISTINCT unique_id AS node, lower(trim(unnest(keywords))) AS theme FROM chunks WHERE unique_id IS NOT NULL),
e AS (SELECT node, theme FROM o WHERE theme <> ''),
l AS (SELECT list(DISTINCT item) AS k FROM lexicon WHERE field = 'keyword'),
f AS (SELECT DISTINCT unique_id AS node, unnest(list_filter(k, lambda t: contains(lower(text), lower(t)))) AS theme FROM chunks, l WHERE unique_id IS NOT NULL AND text IS NOT NULL)
SELECT node, theme, 'tagged' AS origin FROM e UNION ALL SELECT node, theme, 'text' FROM f WHERE (node, theme) NOT IN (SELECT (node, theme) FROM e)""")
def theme_upsert(spark, sf):
    """Theme edges of the nodes' own tags, and those that their texts add."""
    nodes = chunks(spark, sf).where("unique_id is not null").select(F.col("unique_id").alias("node"), "keywords", "text")
    own = nodes.select("node", F.explode("keywords").alias("theme")).withColumn("theme", F.lower(F.trim("theme"))).where("theme <> ''").distinct().withColumn("origin", F.lit("tagged"))
    found = nodes.where("text is not null").select("node", F.explode(tx.contained_terms(F.col("text"), _lexicon(spark, sf, "keyword"))).alias("theme")).distinct().withColumn("origin", F.lit("text"))
    return graph.upsert(own, found, ["node", "theme"])


# ---- graph statistics, lookup, merging


def _graph(spark, sf):
    nodes = table(spark, sf, "build_graph").select(F.col("unique_id").alias("node")).distinct()
    return nodes, pairs(spark, sf).join(nodes.withColumnRenamed("node", "src"), "src", "left_semi").join(nodes.withColumnRenamed("node", "dst"), "dst", "left_semi")


GRAPH = f"""{PAIRS}, nodes AS (SELECT DISTINCT unique_id AS node FROM build_graph),
inner_pairs AS (SELECT * FROM pairs WHERE src IN (SELECT node FROM nodes) AND dst IN (SELECT node FROM nodes)),
deg AS (SELECT node, count(e) AS degree FROM nodes LEFT JOIN (SELECT src AS e FROM inner_pairs UNION ALL SELECT dst FROM inner_pairs) ON e = node GROUP BY 1)"""


@query(f"WITH {GRAPH} SELECT count(*) AS n_nodes, avg(degree) AS avg_degree, max(degree) AS max_degree, min(degree) AS min_degree, count(*) FILTER (degree = 0) AS n_isolated FROM deg")
def degree_stats(spark, sf):
    return graph.degree_stats(*_graph(spark, sf))


@query(f"WITH {GRAPH} SELECT node, degree FROM deg")
def node_degrees(spark, sf):
    return graph.degrees(*_graph(spark, sf))


@query(f"WITH {GRAPH} SELECT node FROM deg WHERE degree = 0")
def isolated_nodes(spark, sf):
    return graph.isolated_nodes(*_graph(spark, sf))


@query("""WITH d AS (SELECT DISTINCT node1, node2 FROM edges WHERE node1 IS NOT NULL AND node2 IS NOT NULL)
SELECT node, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree FROM (SELECT node1 AS node, 1 AS o, 0 AS i FROM d UNION ALL SELECT node2, 0, 1 FROM d) GROUP BY 1""")
def directed_degrees(spark, sf):
    d = table(spark, sf, "edges").where("node1 is not null and node2 is not null").select("node1", "node2").distinct()
    ends = d.select(F.explode(F.array(F.struct(F.col("node1").alias("node"), F.lit(1).alias("o")), F.struct(F.col("node2").alias("node"), F.lit(0).alias("o")))).alias("x")).select("x.*")
    return ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum(1 - F.col("o")).alias("in_degree"))


def _files(spark, sf):
    return chunks(spark, sf).where("source_file is not null").select(F.col("unique_id").alias("node"), F.col("source_file").alias("group"))


CROSS = f"""{CHUNKS}, {PAIRS}, f AS (SELECT unique_id AS node, source_file AS file FROM chunks WHERE source_file IS NOT NULL),
both_ways AS (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs),
cross_counts AS (SELECT a.file AS group1, b.file AS group2, count(*) AS n_edges FROM both_ways JOIN f a ON a.node = src JOIN f b ON b.node = dst WHERE a.file <> b.file GROUP BY 1, 2)"""


@query(f"WITH {CROSS} SELECT * FROM cross_counts")
def cross_file_edges(spark, sf):
    return shared_edges.cross_group_counts(pairs(spark, sf), _files(spark, sf))


_STEM_SQL = r"lower(regexp_replace({0}, '(?i)( \(copy\)|_[0-9]+|_rev|-v[0-9]+|_[0-9]+(st|nd|rd|th)_ed)?\.[^.]*$', ''))"


@query(f"""WITH c AS (SELECT source_file, title, author, {_STEM_SQL.format('source_file')} AS node FROM source_catalog WHERE source_file IS NOT NULL)
SELECT node, count(DISTINCT source_file) AS n_merged, coalesce(array_to_string(list_sort(list(DISTINCT title) FILTER (title <> '')), '|'), '') AS title,
coalesce(array_to_string(list_sort(list(DISTINCT author) FILTER (author <> '')), '|'), '') AS author FROM c GROUP BY 1""")
def alias_node_merge(spark, sf):
    """The books of the catalogue under the names of their first copies, titles and authors combined."""
    books = table(spark, sf, "source_catalog").select(F.col("source_file").alias("node"), "title", "author")
    aliases = books.where("node is not null").select(F.col("node").alias("alias"), filenames.copy_stem(F.col("node")).alias("canonical")).distinct()
    out = graph.merge_alias_nodes(books, aliases, ["title", "author"])
    return out.withColumns({c: F.array_join(c, "|") for c in ("title", "author")})


@query(f"""WITH {CROSS}, m AS (SELECT {_STEM_SQL.format('group1')} AS a, {_STEM_SQL.format('group2')} AS b, n_edges FROM cross_counts WHERE group1 < group2)
SELECT least(a, b) AS src, greatest(a, b) AS dst, sum(n_edges)::BIGINT AS weight FROM m WHERE a <> b GROUP BY 1, 2""")
def alias_merge(spark, sf):
    """Files whose names differ by a copy mark are one: edges between files move to the canonical name."""
    between = shared_edges.cross_group_counts(pairs(spark, sf), _files(spark, sf)).where("group1 < group2").select(F.col("group1").alias("src"), F.col("group2").alias("dst"), F.col("n_edges").alias("weight"))
    names = table(spark, sf, "build_graph").select("source_file").union(table(spark, sf, "source_catalog").select("source_file")).where("source_file is not null").distinct()
    return graph.merge_aliases(between, names.select(F.col("source_file").alias("alias"), filenames.copy_stem(F.col("source_file")).alias("canonical")))


@query(f"""WITH {CHUNKS}, r AS (SELECT DISTINCT label, id, original_source_file AS f FROM simple_gml_to_csv),
e AS (SELECT node1, node2, row_number() OVER () AS k FROM edges), x AS (SELECT k, node1 AS o, 1 AS side FROM e UNION ALL SELECT k, node2, 2 FROM e),
j AS (SELECT k, side, count(r.id) AS n, count(r.id) FILTER (r.f = c.source_file) AS nf FROM x LEFT JOIN chunks c ON c.unique_id = o LEFT JOIN r ON r.label = o GROUP BY 1, 2),
s AS (SELECT k, max(CASE WHEN n = 0 THEN 'missing' WHEN n = 1 OR nf = 1 THEN 'resolved' ELSE 'ambiguous' END) FILTER (side = 1) AS a, max(CASE WHEN n = 0 THEN 'missing' WHEN n = 1 OR nf = 1 THEN 'resolved' ELSE 'ambiguous' END) FILTER (side = 2) AS b FROM j GROUP BY 1)
SELECT CASE WHEN a <> 'resolved' THEN a ELSE b END AS status, count(*) AS n FROM s GROUP BY 1""")
def endpoint_resolution(spark, sf):
    """Edge rows by what becomes of them when both ends are resolved; a loaded repetition is a row of its own."""
    hints = chunks(spark, sf).select(F.col("unique_id").alias("original_id"), F.col("source_file").alias("hint"))
    registry = table(spark, sf, "simple_gml_to_csv").select(F.col("label").alias("original_id"), F.col("id").alias("final_id"), F.col("original_source_file").alias("source_file"))
    found = graph.resolve_edges(table(spark, sf, "edges"), hints, registry)
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {TYPED}, l AS (SELECT DISTINCT label FROM simple_gml_to_csv WHERE label IS NOT NULL)
SELECT src AS start_id, dst AS end_id, edge_type AS relationship_type, weight::DOUBLE AS weight FROM typed WHERE src IN (SELECT label FROM l) AND dst IN (SELECT label FROM l)""")
def export_edges(spark, sf):
    return export.export_edges(typed_edges(spark, sf), table(spark, sf, "simple_gml_to_csv").select(F.col("label").alias("id")).where("id is not null"))


@query(f"""WITH {TYPED} SELECT upper(edge_type) AS relationship_type, count(*) AS n_edges, sum(weight)::BIGINT AS weight FROM typed GROUP BY 1""")
def export_edges_by_type(spark, sf):
    return typed_edges(spark, sf).groupBy(F.upper("edge_type").alias("relationship_type")).agg(F.count(F.lit(1)).alias("n_edges"), F.sum("weight").alias("weight"))


@query(f"""WITH {CHUNKS} SELECT 'export_' || unique_id AS id, 'Node' AS node_label, 'export.gml' AS source_file, left(coalesce(text, ''), 1000) AS text,
coalesce(array_to_string(list_filter(entities, lambda x: x IS NOT NULL), ', '), '') AS entities, coalesce(array_to_string(list_filter(keywords, lambda x: x IS NOT NULL), ', '), '') AS keywords,
coalesce(array_to_string(list_filter(figures, lambda x: x IS NOT NULL), ', '), '') AS figures, coalesce(parent_id, '') AS parent_id, unique_id AS label, coalesce(source_file, '') AS original_source_file
FROM chunks WHERE unique_id IS NOT NULL""")
def export_nodes(spark, sf):
    return export.export_nodes(table(spark, sf, "build_graph"), "export")


ATTRIBUTES = ("text", "entities", "keywords", "figures", "parent_id", "label", "node_label", "original_source_file")


@query("SELECT id, " + ", ".join(f"arg_max({a}, source_file || chr(1) || {a}) FILTER ({a} <> '' AND source_file IS NOT NULL) AS {a}" for a in ATTRIBUTES) + " FROM simple_gml_to_csv WHERE id IS NOT NULL GROUP BY 1")
def graph_compose_last_wins(spark, sf):
    """Each node once, every attribute from the last graph that gives it a value."""
    rows = table(spark, sf, "simple_gml_to_csv")
    every = rows.where("id is not null").select("id").distinct()
    return every.join(graph.compose(rows.where("source_file is not null"), "id", "source_file", ATTRIBUTES), "id", "left")


@query("""SELECT DISTINCT unique_id AS label, coalesce(source_file, '') AS source_file, md5(coalesce(text, '')) AS text_md5, coalesce(array_to_string(list_filter(entities, lambda x: x IS NOT NULL), ','), '') AS entities
FROM build_graph WHERE unique_id IS NOT NULL""")
def gml_round_trip(spark, sf):
    """The nodes written as a GML graph into the shared folder and read again."""
    none = F.lit("")
    props = F.create_map(F.lit("label"), F.col("unique_id"), F.lit("source_file"), F.coalesce("source_file", none), F.lit("text"), F.coalesce("text", none), F.lit("entities"), F.concat_ws(",", "entities"))
    nodes = table(spark, sf, "build_graph").where("unique_id is not null").select("unique_id", "source_file", "text", "entities").distinct().select(F.lit("node").alias("block"), props.alias("props"))
    folder = f"{ensure_checkpoint_dir(spark)}/gml-{uuid.uuid4().hex}"
    gml.write_gml(nodes, folder)
    p = lambda name: F.col("props")[name]
    return gml.read_gml(spark, folder).where("block = 'node' and error is null").select(p("label").alias("label"), p("source_file").alias("source_file"), F.md5(p("text")).alias("text_md5"), p("entities").alias("entities"))


@query("""WITH RECURSIVE p AS (SELECT DISTINCT source_file AS f, label AS l FROM simple_gml_to_csv WHERE source_file IS NOT NULL AND label IS NOT NULL),
g AS (SELECT f, row_number() OVER (ORDER BY f) AS k FROM (SELECT DISTINCT f FROM p)),
c AS (SELECT b.f, list(DISTINCT a.f) AS earlier FROM p a JOIN p b ON a.l = b.l AND a.f < b.f GROUP BY 1),
run AS (SELECT 0::BIGINT AS k, []::VARCHAR[] AS clean UNION ALL
  SELECT g.k, CASE WHEN list_has_any(coalesce(c.earlier, []), run.clean) THEN run.clean ELSE list_append(run.clean, g.f) END FROM run JOIN g ON g.k = run.k + 1 LEFT JOIN c ON c.f = g.f),
z AS (SELECT clean FROM run ORDER BY k DESC LIMIT 1)
SELECT f AS source_file, l AS label, CASE WHEN list_contains(clean, f) THEN l ELSE f || '_' || l END AS merged_id FROM p, z""")
def prefix_on_conflict_merge(spark, sf):
    return graph.merge_with_prefix(table(spark, sf, "simple_gml_to_csv").select("source_file", "label"), "source_file", "label")


def _weighted_pairs(spark, sf):
    return typed_edges(spark, sf).where("src <> dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


@query(f"""WITH RECURSIVE {PAIRS}, nodes AS (SELECT DISTINCT unique_id AS node FROM build_graph WHERE unique_id IS NOT NULL UNION SELECT src FROM pairs UNION SELECT dst FROM pairs),
s AS (SELECT src AS a, dst AS b FROM pairs UNION ALL SELECT dst, src FROM pairs),
reach(node, component) USING KEY (node) AS (SELECT node, node FROM nodes UNION
  SELECT s.b, min(r.component) FROM reach r JOIN s ON s.a = r.node JOIN recurring.reach o ON o.node = s.b WHERE r.component < o.component GROUP BY s.b)
SELECT node, component FROM reach""")
def connected_component_labels(spark, sf):
    """The component of every node, over all pairs of any weight; a node without an edge is one of its own."""
    nodes = table(spark, sf, "build_graph").where("unique_id is not null").select(F.col("unique_id").alias("node")).distinct()
    return nodes.join(connected_components(table(spark, sf, "edges"), "node1", "node2"), "node", "full").select("node", F.coalesce("component", "node").alias("component"))


#: The reference asks for words of its own library, which no text of these tables holds; these stand in: of a start, its file and an end.
ROUTE = {"start": "mercy", "file": "Servant", "end": "vocation"}


def _route_sql() -> str:
    """Front halves of up to three edges and back halves of up to two, and the trails that they make."""
    parts = [
        TYPED,
        "w AS (SELECT src, dst, sum(weight)::BIGINT AS weight, src || chr(1) || dst AS e FROM typed WHERE src <> dst GROUP BY 1, 2)",
        "s AS (SELECT src AS a, dst AS b, e, weight FROM w UNION ALL SELECT dst, src, e, weight FROM w)",
        f"f0 AS (SELECT DISTINCT unique_id AS o, unique_id AS a, []::VARCHAR[] AS u, 0::BIGINT AS t FROM build_graph WHERE contains(text, '{ROUTE['start']}') AND contains(source_file, '{ROUTE['file']}'))",
        f"b0 AS (SELECT DISTINCT unique_id AS o, unique_id AS a, []::VARCHAR[] AS u, 0::BIGINT AS t FROM build_graph WHERE contains(text, '{ROUTE['end']}'))",
    ]
    for side, most in (("f", 3), ("b", 2)):
        parts += [f"{side}{k} AS (SELECT o, s.b AS a, list_append(u, s.e) AS u, t + s.weight AS t FROM {side}{k - 1} x JOIN s ON s.a = x.a WHERE NOT list_contains(u, s.e))" for k in range(1, most + 1)]
    found = [f"SELECT f.o AS start, b.o AS finish, {k} AS n_hops, f.t + b.t AS weight FROM f{(k + 1) // 2} f JOIN b{k // 2} b ON f.a = b.a WHERE NOT list_has_any(f.u, b.u)" for k in range(1, 6)]
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(found)


@query(_route_sql())
def k_hop_paths(spark, sf):
    """All trails of 1 to 5 edges from nodes whose text and file name hold a word to nodes whose text holds another."""
    nodes = table(spark, sf, "build_graph").select(F.col("unique_id").alias("node"), "text", "source_file")
    starts = nodes.where(F.contains("text", F.lit(ROUTE["start"])) & F.contains("source_file", F.lit(ROUTE["file"]))).select("node").distinct()
    ends = nodes.where(F.contains("text", F.lit(ROUTE["end"]))).select("node").distinct()
    return graph.trails_between(_weighted_pairs(spark, sf), starts, ends, 5)


@query("""SELECT min(doc_id) AS doc_id, count(*) AS n_copies, length(any_value(text)) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1""")
def dedup_by_text(spark, sf):
    rows = table(spark, sf, "documents").where("text is not null").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))
    return rows.where("n_copies > 1").select("doc_id", "n_copies", F.char_length("text").cast("bigint").alias("n_chars"))


@query("""WITH e AS (SELECT source_file, count(*) AS n_rows, count(DISTINCT id) AS n_ids, round(avg(length(text)), 6) AS mean_chars FROM simple_gml_to_csv GROUP BY 1) SELECT *, n_rows - n_ids AS n_repeated FROM e""")
def export_summary(spark, sf):
    """Totals and means of each export file."""
    out = table(spark, sf, "simple_gml_to_csv").groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"), F.round(F.avg(F.char_length("text")), 6).alias("mean_chars"))
    return out.withColumn("n_repeated", F.col("n_rows") - F.col("n_ids"))


@query("""SELECT count(*) AS n_candidates, count(DISTINCT {'a': least(node1, node2), 'b': greatest(node1, node2)}) AS n_unique FROM edges WHERE node1 IS NOT NULL AND node2 IS NOT NULL""")
def edge_dedup_ratio(spark, sf):
    per_pair = shared_edges.unordered(table(spark, sf, "edges")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    return per_pair.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_candidates"), F.count(F.lit(1)).alias("n_unique"))


@query(f"""WITH {CHUNKS}, {PAIRS}, t AS (SELECT unique_id AS node FROM chunks WHERE text LIKE '%Grokalm Vepam%'), e AS (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs)
SELECT e.src AS node, e.dst AS neighbour, c.source_file FROM e JOIN t ON t.node = e.src JOIN chunks c ON c.unique_id = e.dst""")
def neighbours_of_matches(spark, sf):
    """Nodes whose text names a figure, with their neighbours."""
    nodes = chunks(spark, sf)
    found = nodes.where(F.contains("text", F.lit("Grokalm Vepam"))).select(F.col("unique_id").alias("src"))
    ends = nodes.select(F.col("unique_id").alias("dst"), "source_file")
    return shared_edges.symmetric(pairs(spark, sf)).join(found, "src").join(ends, "dst").select(F.col("src").alias("node"), F.col("dst").alias("neighbour"), "source_file")


@query(f"""WITH {CHUNKS}, r AS (SELECT source_file, parent_id, child_id, row_number() OVER (PARTITION BY source_file, parent_id ORDER BY node_id) AS k, count(*) OVER (PARTITION BY source_file, parent_id) AS n FROM chunks WHERE source_file IS NOT NULL AND parent_id IS NOT NULL)
SELECT source_file, parent_id, any_value(n) AS n_children, string_agg(child_id, '|' ORDER BY k) FILTER (k <= 3) AS first_children FROM r GROUP BY 1, 2""")
def children_of_parents(spark, sf):
    """Each parent with the number of its children and the first three."""
    w = Window.partitionBy("source_file", "parent_id")
    rows = chunks(spark, sf).where("source_file is not null and parent_id is not null")
    rows = rows.select("source_file", "parent_id", "child_id", F.row_number().over(w.orderBy("node_id")).alias("k"))
    first = F.array_sort(F.collect_list(F.when(F.col("k") <= 3, F.struct("k", "child_id"))))
    return rows.groupBy("source_file", "parent_id").agg(F.count(F.lit(1)).alias("n_children"), F.array_join(F.transform(first, lambda x: x["child_id"]), "|").alias("first_children"))


# ---- text


@query("""SELECT doc_id, array_to_string(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
'\\t', ' ', 'g'), ' {2,}', ' ', 'g'), '-[ \\t\\n\\r\\f\\v]*\\n[ \\t\\n\\r\\f\\v]*', '', 'g'), '[ \\t\\n\\r\\f\\v]+([,.;:!?])', '\\1', 'g'), '(["(\\[])[ \\t\\n\\r\\f\\v]+', '\\1', 'g'), '[ \\t\\n\\r\\f\\v]+([")\\]])', '\\1', 'g'),
'\\n{3,}', chr(10) || chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '^[ \\t\\r\\f\\v]+|[ \\t\\r\\f\\v]+$', '', 'g')), chr(10)) AS text FROM documents""")
def clean_text_layout(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.tidy_layout(F.col("text")).alias("text"))


#: Corrections for the test corpus; the operator takes any.
CORRECTIONS = {"shoreline": "shore line", "the lamp": "a lamp", "gatekeeper": "porter"}


@query("""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(
regexp_replace(regexp_replace(text, '(^|[^\\p{L}\\p{N}_])(?i:shoreline)([^\\p{L}\\p{N}_]|$)', '\\1shore line\\2', 'g'), '(^|[^\\p{L}\\p{N}_])(?i:shoreline)([^\\p{L}\\p{N}_]|$)', '\\1shore line\\2', 'g'),
'(^|[^\\p{L}\\p{N}_])(?i:the lamp)([^\\p{L}\\p{N}_]|$)', '\\1a lamp\\2', 'g'), '(^|[^\\p{L}\\p{N}_])(?i:gatekeeper)([^\\p{L}\\p{N}_]|$)', '\\1porter\\2', 'g'), 'x^', '') AS text FROM documents""")
def ocr_polish(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.replace_words(F.col("text"), CORRECTIONS).alias("text"))


@query("""SELECT node_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '[\\t\\n\\v\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g'),
'[^\\p{L}\\p{N}_ .,;:!?\\-''"]', ' ', 'g'), ' +', ' ', 'g')) AS text FROM (SELECT DISTINCT node_id, text FROM build_graph)""")
def clean_text_plain(spark, sf):
    return table(spark, sf, "build_graph").select("node_id", "text").distinct().select("node_id", tx.plain_text(F.col("text")).alias("text"))


MOST_TERMS = 10_000


def _lexicon(spark, sf, field):
    """The items of one field, a table of fixed size."""
    found = [r.item for r in table(spark, sf, "lexicon").where((F.col("field") == field) & F.col("item").isNotNull()).select("item").distinct().limit(MOST_TERMS + 1).collect()]
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} items of {field} in the lexicon")
    return sorted(found)


@query("""WITH l AS (SELECT list_sort(list(DISTINCT item)) AS k FROM lexicon WHERE field = 'keyword') SELECT doc_id, array_to_string(list_filter(k, lambda t: contains(lower(text), lower(t))), '|') AS keywords FROM documents, l""")
def keyword_tags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(tx.contained_terms(F.col("text"), _lexicon(spark, sf, "keyword")), "|").alias("keywords"))


@query("""WITH l AS (SELECT list_sort(list(DISTINCT item)) AS k FROM lexicon WHERE field = 'figure') SELECT doc_id, array_to_string(list_filter(k, lambda t: regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])' || lower(t) || '([^\\p{L}\\p{N}_]|$)')), '|') AS figures FROM documents, l""")
def figure_tags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(tx.whole_terms(F.col("text"), _lexicon(spark, sf, "figure")), "|").alias("figures"))


@query("""SELECT node_id, array_to_string(regexp_extract_all(array_to_string(list_filter(verses, lambda x: x IS NOT NULL), ' ; '), '\\b(?:\\d\\s)?[A-Z][a-z]+(?:\\s[A-Z][a-z]+)?\\s\\d+:\\d+(?:-\\d+)?(?:,\\s?\\d+)*\\b'), '|') AS refs
FROM (SELECT DISTINCT node_id, verses FROM build_graph) WHERE verses IS NOT NULL""")
def verse_refs(spark, sf):
    rows = table(spark, sf, "build_graph").select("node_id", "verses").where("verses is not null").distinct()
    return rows.select("node_id", F.array_join(tx.verse_references(F.concat_ws(" ; ", "verses")), "|").alias("refs"))


THEMES = "WITH l AS (SELECT DISTINCT item FROM lexicon WHERE field = 'keyword')"


@query(f"""{THEMES} SELECT item AS theme, count(*) AS n_nodes FROM (SELECT DISTINCT item, unique_id FROM build_graph JOIN l ON contains(lower(text), lower(item))) GROUP BY 1""")
def theme_tagging(spark, sf):
    """Each theme once, with the number of chunks whose text names it."""
    rows = table(spark, sf, "build_graph").select("unique_id", F.explode(tx.contained_terms(F.col("text"), _lexicon(spark, sf, "keyword"))).alias("theme")).distinct()
    return rows.groupBy("theme").agg(F.count(F.lit(1)).alias("n_nodes"))


SENTENCES = """sents AS (SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS sent_no FROM (
  SELECT doc_id, trim(unnest(p)) AS s, unnest(range(len(p))) AS i FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?])[ \\t\\n\\r]+', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents)) WHERE s <> '')"""


@query(f"WITH {SENTENCES} SELECT doc_id, sent_no::INT AS sent_no, s AS sentence FROM sents")
def sentence_split(spark, sf):
    return chunking.sentence_rows(table(spark, sf, "documents"), keys=["doc_id"], text="text")


@query("SELECT doc_id, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+'))::INT AS n_words FROM documents WHERE text IS NOT NULL")
def token_counts(spark, sf):
    return table(spark, sf, "documents").where("text is not null").select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query(f"""WITH {SENTENCES}, n AS (SELECT doc_id, count(*) AS n FROM sents GROUP BY 1), l AS (SELECT DISTINCT item FROM lexicon WHERE field = 'keyword'),
k AS (SELECT doc_id, count(*) AS k FROM sents JOIN l ON contains(lower(s), lower(item)) GROUP BY 1)
SELECT doc_id, coalesce(k, 0) / n::DOUBLE AS density, CASE WHEN coalesce(k, 0) / n::DOUBLE > 1.0 THEN 0.35 ELSE 0.25 END::DOUBLE AS threshold FROM n LEFT JOIN k USING (doc_id)""")
def entity_density(spark, sf):
    words = _lexicon(spark, sf, "keyword")
    sents = F.transform(tx.sentences(F.col("text")), lambda s: F.size(tx.contained_terms(s, words)))
    rows = table(spark, sf, "documents").select("doc_id", sents.alias("k")).where(F.size("k") > 0)
    density = F.aggregate("k", F.lit(0), lambda a, x: a + x) / F.size("k")
    return rows.select("doc_id", density.alias("density"), F.when(density > 1.0, 0.35).otherwise(0.25).alias("threshold"))


@query("""WITH t AS (SELECT source_file, node_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM (SELECT DISTINCT source_file, node_id, text FROM build_graph WHERE source_file IS NOT NULL AND text IS NOT NULL)),
tf AS (SELECT source_file, node_id, term, count(*) AS tf FROM t GROUP BY 1, 2, 3), n AS (SELECT source_file, count(DISTINCT node_id) AS n FROM build_graph WHERE text IS NOT NULL GROUP BY 1),
df AS (SELECT source_file, term, count(*) AS df FROM tf GROUP BY 1, 2), r AS (SELECT source_file, node_id, term, tf * (ln((1.0 + n) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (source_file, term) JOIN n USING (source_file)),
w AS (SELECT source_file, node_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY source_file, node_id)) AS weight FROM r)
SELECT source_file, term, round(sum(weight), 6) AS weight FROM w GROUP BY 1, 2""")
def tfidf_term_weights(spark, sf):
    rows = table(spark, sf, "build_graph").select("source_file", "node_id", "text").where("source_file is not null and text is not null").distinct()
    return retrieval.tfidf(rows, group=["source_file"], key="node_id", text="text").groupBy("source_file", "term").agg(F.round(F.sum("weight"), 6).alias("weight"))


@query(f"""WITH {CHUNKS} SELECT count(*) AS n_chunks, round(100.0 * count(*) FILTER (len(entities) > 0) / count(*), 6) AS entities, round(100.0 * count(*) FILTER (len(verses) > 0) / count(*), 6) AS verses,
round(100.0 * count(*) FILTER (len(keywords) > 0) / count(*), 6) AS keywords, round(100.0 * count(*) FILTER (len(figures) > 0) / count(*), 6) AS figures FROM chunks""")
def coverage_stats(spark, sf):
    share = lambda c: F.round(F.count_if(F.size(c) > 0) * 100.0 / F.count(F.lit(1)), 6).alias(c)
    return chunks(spark, sf).agg(F.count(F.lit(1)).alias("n_chunks"), *(share(c) for c in ("entities", "verses", "keywords", "figures")))


@query("SELECT source_file, count(DISTINCT node_id) AS n_chunks, count(DISTINCT parent_id) AS n_parents FROM build_graph GROUP BY 1")
def source_histogram(spark, sf):
    return table(spark, sf, "build_graph").groupBy("source_file").agg(F.count_distinct("node_id").alias("n_chunks"), F.count_distinct("parent_id").alias("n_parents"))


@query("SELECT lower(regexp_extract(source_file, '\\.([^./]*)$', 1)) AS extension, count(*) AS n FROM source_catalog GROUP BY 1")
def extension_histogram(spark, sf):
    return table(spark, sf, "source_catalog").groupBy(tx.file_extension(F.col("source_file")).alias("extension")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH f AS (SELECT source_file FROM source_catalog UNION SELECT source_file FROM build_graph) SELECT {_STEM_SQL.format('source_file')} AS stem, count(*) AS n_files, min(source_file) AS first_name FROM f WHERE source_file IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def duplicate_files(spark, sf):
    return filenames.duplicate_files(table(spark, sf, "source_catalog").select("source_file").union(table(spark, sf, "build_graph").select("source_file")).distinct())


def _cleaned_names(spark, sf):
    names = table(spark, sf, "source_catalog").select("source_file")
    return filenames.rename_plan(names, filenames.clean_file_name(filenames.F.regexp_replace("source_file", r" \(copy\)|-v[0-9]+", ""), ["The_"]))


@query(r"""WITH a AS (SELECT source_file AS old_name, regexp_replace(source_file, ' \(copy\)|-v[0-9]+', '', 'g') AS x FROM source_catalog),
b AS (SELECT old_name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '\.[^.]*$', ''), '_+', '_', 'g'), '(?i)^The_', ''), '^[_\-]+|[_\-]+$', '', 'g'), '_+', '_', 'g') AS stem, regexp_extract(x, '(\.[^.]*)$', 1) AS ext FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY stem || ext ORDER BY old_name) - 1 AS k FROM b) SELECT old_name, CASE WHEN k = 0 THEN stem || ext ELSE stem || '_' || k || ext END AS new_name FROM c""")
def filename_clean(spark, sf):
    return _cleaned_names(spark, sf)


@query("SELECT source_file FROM source_catalog WHERE source_file NOT IN (SELECT DISTINCT source_file FROM documents WHERE source_file IS NOT NULL)")
def processed_anti_join(spark, sf):
    done = table(spark, sf, "documents").select("source_file").where("source_file is not null").distinct()
    return table(spark, sf, "source_catalog").select("source_file").join(done, "source_file", "left_anti")


# ---- chunking


def _windows_sql(size: int, overlap: int, stops: str, kept: int) -> str:
    span = f"text[a + 1 : a + {size}]"
    stop = f"length({span}) - length(regexp_extract({span}, '[^{stops}]*$'))"
    end = f"CASE WHEN a + {size} >= length(text) THEN length(text) WHEN {stop} > 1 THEN a + {stop} - {1 - kept} ELSE a + {size} END"
    blank = r"[\t\n\v\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    return f"""WITH RECURSIVE s AS (SELECT doc_id, text, 0 AS a, 0 AS k FROM documents WHERE text <> ''), w AS (SELECT *, {end} AS b FROM s UNION ALL SELECT doc_id, text, a, k, {end} AS b FROM (
  SELECT doc_id, text, k + 1 AS k, CASE WHEN b < length(text) THEN greatest(b - {overlap}, a + 1) ELSE a + {size - overlap} END AS a FROM w) WHERE a < length(text)),
t AS (SELECT doc_id, a AS start, k, regexp_replace(text[a + 1 : b], '^{blank}|{blank}$', '', 'g') AS text FROM w)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k))::INT AS chunk_no, start, text FROM t WHERE text <> ''"""


@query(_windows_sql(1500, 200, ".!?", 1))
def fixed_window_chunks(spark, sf):
    return chunking.fixed_windows(table(spark, sf, "documents"), key="doc_id", text="text", size=1500, overlap=200, tail=True)


@query(_windows_sql(400, 50, " ", 0))
def word_window_chunks(spark, sf):
    return chunking.fixed_windows(table(spark, sf, "documents"), key="doc_id", text="text", size=400, overlap=50, at="space", tail=True)


@query()
def recursive_chunks(spark, sf):
    return chunking.split_recursively(table(spark, sf, "documents"), key="doc_id", text="text")


@query()
def parent_chunks(spark, sf):
    return chunking.parent_chunks(table(spark, sf, "documents"), key="doc_id", text="text")


@query()
def hybrid_chunks(spark, sf):
    parents = chunking.parent_chunks(table(spark, sf, "documents"), key="doc_id", text="text")
    sents = chunking.sentence_rows(parents, keys=["doc_id", "parent_no"], text="text")
    out = chunking.hybrid_chunks(sents, group=["doc_id", "parent_no"], terms=_lexicon(spark, sf, "keyword"), most_words=200, stop=tx.STOP_WORDS)
    return out.withColumn("items", F.array_join("items", "|"))


@query()
def document_chunks(spark, sf):
    """The whole way from a document to its marked chunks."""
    out = chunking.chunk_documents(table(spark, sf, "documents"), key="doc_id", text="text", keywords=_lexicon(spark, sf, "keyword"), figures=_lexicon(spark, sf, "figure"))
    return out.withColumns({c: F.array_join(c, "|") for c in ("keywords", "figures", "verses")})


# ---- vectors and retrieval


def _query_vector(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return vectors, [float(x) for x in vectors.orderBy("vec_id").first().embedding]


_Q = "q AS (SELECT embedding AS qe FROM embeddings ORDER BY vec_id LIMIT 1)"
_D = "list_sum(list_transform(range(1, 65), lambda i: (e.embedding[i]::DOUBLE - {0}[i]::DOUBLE) * (e.embedding[i]::DOUBLE - {0}[i]::DOUBLE)))"
_DOT = "list_sum(list_transform(range(1, 65), lambda i: {0}[i]::DOUBLE * {1}[i]::DOUBLE))"


@query(f"WITH {_Q} SELECT vec_id, round({_D.format('qe')}, 6) AS distance FROM embeddings e, q ORDER BY {_D.format('qe')}, vec_id LIMIT 10")
def knn_l2(spark, sf):
    vectors, q = _query_vector(spark, sf)
    return retrieval.nearest(vectors, q, 10).select("vec_id", F.round("distance", 6).alias("distance"))


@query(f"WITH {_Q}, d AS (SELECT vec_id, 1 - {_DOT.format('embedding', 'qe')} / (sqrt({_DOT.format('embedding', 'embedding')}) * sqrt({_DOT.format('qe', 'qe')})) AS d FROM embeddings, q) SELECT vec_id, round(d, 6) AS distance FROM d ORDER BY round(d, 9), vec_id LIMIT 10")
def knn_cosine(spark, sf):
    vectors, q = _query_vector(spark, sf)
    return retrieval.nearest(vectors, q, 10, metric="cosine").select("vec_id", F.round("distance", 6).alias("distance"))


MULTI = f"""WITH d AS (SELECT x.vec_id AS query_id, e.vec_id, round({_D.format('x.embedding')}, 9) AS distance FROM embeddings x, embeddings e WHERE x.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)"""


def _multi(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return retrieval.nearest_for_all(vectors, vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 5)


@query(f"{MULTI} SELECT query_id, rank::INT AS rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5")
def knn_multi_query(spark, sf):
    """Queries: every row whose id is divisible by 20, against all rows."""
    return _multi(spark, sf).withColumn("distance", F.round("distance", 6))


@query(f"{MULTI} SELECT query_id, rank::INT AS rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5")
def ann_all_cells(spark, sf):
    """Every cell of the index probed: every row is in it, and the result is exact."""
    vectors = table(spark, sf, "embeddings")
    centres = ann.fit_centres(vectors, 16)
    found = ann.probe(ann.cells_of(vectors, centres), vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), centres, 5, n_probe=16)
    return found.withColumn("distance", F.round("distance", 6))


@query()
def ann_recall(spark, sf):
    """Share of the five nearest rows that the nearest cells hold, over the query set."""
    vectors = table(spark, sf, "embeddings")
    queries = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    centres = ann.fit_centres(vectors, 16)
    found = ann.probe(ann.cells_of(vectors, centres), queries, centres, 5, n_probe=12).select("query_id", "vec_id", F.lit(1).alias("hit"))
    true = _multi(spark, sf).select("query_id", "vec_id")
    return true.join(found, ["query_id", "vec_id"], "left").agg(F.count(F.lit(1)).alias("n_true"), F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall"))


@query("SELECT doc_id, (length(text) // 4)::BIGINT AS n_tokens FROM documents")
def token_estimates(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.estimated_tokens(F.col("text")).alias("n_tokens"))


@query(f"""{MULTI}, l AS (SELECT query_id, list(vec_id) AS a FROM r WHERE rank <= 5 GROUP BY 1), m AS (SELECT query_id, list(vec_id) AS b FROM r WHERE rank BETWEEN 2 AND 6 GROUP BY 1)
SELECT query_id, len(list_intersect(a, b)) * 100.0 / 5 AS overlap_percent FROM l JOIN m USING (query_id)""")
def topk_overlap(spark, sf):
    """Overlap of the five nearest rows with the five nearest others."""
    vectors = table(spark, sf, "embeddings")
    found = retrieval.nearest_for_all(vectors, vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 6)
    lists = found.groupBy("query_id").agg(F.collect_list(F.when(F.col("rank") <= 5, F.col("vec_id"))).alias("a"), F.collect_list(F.when(F.col("rank") >= 2, F.col("vec_id"))).alias("b"))
    return lists.select("query_id", (F.size(F.array_intersect("a", "b")) * 100.0 / 5).cast("double").alias("overlap_percent"))


@query("SELECT position, vec_id, label FROM (SELECT unnest([40, 3, 99999999, 7]) AS id, unnest(range(4))::INT AS position) JOIN embeddings ON vec_id = id")
def vector_get(spark, sf):
    return retrieval.by_ids(table(spark, sf, "embeddings"), [40, 3, 99_999_999, 7], "vec_id").select("position", "vec_id", "label")


@query(f"SELECT vec_id, round(sqrt({_DOT.format('embedding', 'embedding')}), 6) AS length, round(embedding[1]::DOUBLE / sqrt({_DOT.format('embedding', 'embedding')}), 6) AS first_value FROM embeddings")
def l2_normalize(spark, sf):
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select("vec_id", F.round(vector.norm(e), 6).alias("length"), F.round(F.get(vector.normalized(e), F.lit(0)), 6).alias("first_value"))


@query("SELECT label, (i - 1)::INT AS position, round(avg(embedding[i]::DOUBLE), 6) AS mean FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2")
def label_centroids(spark, sf):
    return retrieval.centroids(table(spark, sf, "embeddings"), "label").withColumn("mean", F.round("mean", 6))


ASKED = ("costly", "summer", "fenêtre")
_TF = "len(list_filter(w, lambda x: x = '{0}'))"
BM25 = f"""WITH d AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, text, len(w) AS n, {', '.join(f'{_TF.format(t)} AS t{j}' for j, t in enumerate(ASKED))} FROM d),
s AS (SELECT count(*) AS total, avg(n) AS mean, {', '.join(f'count(*) FILTER (t{j} > 0) AS d{j}' for j in range(3))} FROM c),
b AS (SELECT doc_id, text, {' + '.join(f'ln(1 + (total - d{j} + 0.5) / (d{j} + 0.5)) * t{j} * 2.2 / (t{j} + 1.2 * (0.25 + 0.75 * n / mean))' for j in range(3))} AS score, {' + '.join(f'least(t{j}, 1)' for j in range(3))} AS hits FROM c, s WHERE t0 + t1 + t2 > 0)"""


@query(f"{BM25} SELECT doc_id, round(score, 6) AS score FROM b")
def bm25_search(spark, sf):
    return retrieval.bm25(table(spark, sf, "documents"), ASKED, key="doc_id", text="text").withColumn("score", F.round("score", 6))


def _reranked(spark, sf, n=5):
    docs = table(spark, sf, "documents")
    first = retrieval.bm25(docs, ASKED, key="doc_id", text="text").withColumn("score", F.round("score", 6)).orderBy(F.desc("score"), "doc_id").limit(retrieval.candidates_wanted(n, True, 15))
    return retrieval.rerank(first.join(docs, "doc_id"), retrieval.lexical_score(F.col("text"), ASKED), n, "doc_id")


RERANK = f"{BM25}, f AS (SELECT * FROM b ORDER BY round(score, 6) DESC, doc_id LIMIT 15), k AS (SELECT doc_id, hits / 3.0 AS rerank_score FROM f ORDER BY 2 DESC, 1 LIMIT 5)"


@query(f"{RERANK} SELECT doc_id, round(rerank_score, 6) AS rerank_score FROM k")
def rerank_top_n(spark, sf):
    return _reranked(spark, sf).select("doc_id", F.round("rerank_score", 6).alias("rerank_score"))


@query(f"""{RERANK}, o AS (SELECT row_number() OVER (ORDER BY rerank_score DESC, k.doc_id) AS rank, d.text, d.source_file, c.author, c.title FROM k JOIN documents d USING (doc_id) LEFT JOIN source_catalog c USING (source_file)),
r AS (SELECT rank, coalesce(text, '') AS text, CASE WHEN author IS NULL AND title IS NULL THEN coalesce(source_file, 'Unknown') ELSE concat_ws(', ', author, '"' || title || '"') END AS cite FROM o)
SELECT string_agg('[Source ' || rank || ' - ' || cite || ']:' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context, string_agg('Source ' || rank || ': ' || cite, chr(10) ORDER BY rank) AS guide FROM r""")
def citation_context(spark, sf):
    top = _reranked(spark, sf).join(table(spark, sf, "source_catalog").select("source_file", "title", "author"), "source_file", "left")
    rank = F.row_number().over(Window.orderBy(F.desc("rerank_score"), "doc_id"))  # over five rows
    return retrieval.context(top.select(rank.alias("rank"), retrieval.citation(F.col("title"), F.col("author"), F.col("source_file")).alias("citation"), "text"))


@query("""SELECT d.doc_id, coalesce(nullif(concat_ws(', ', 'Sermon #' || d.doc_id, strftime(d.fetched_at, '%Y'), '"' || nullif(c.title, '') || '"'), ''), 'Unknown Source') AS citation FROM documents d LEFT JOIN source_catalog c USING (source_file)""")
def full_citations(spark, sf):
    """The citation of every document by its number, year and title."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "source_catalog").select("source_file", "title"), "source_file", "left")
    cited = retrieval.full_citation(F.col("doc_id"), F.date_format("fetched_at", "yyyy"), F.col("title"), F.lit(None).cast("string"), F.col("source_file"))
    return docs.select("doc_id", cited.alias("citation"))


# ---- usage-like records and event time


@query("SELECT event_type, count(*) AS n, sum(value) AS total, round(quantile_cont(value, 0.95), 6) AS p95, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def latency_percentiles(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.round(F.percentile("value", 0.95), 6).alias("p95"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running FROM events")
def running_total(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf, "events").select("event_id", F.round(F.sum("value").over(w), 4).alias("running"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def windowed_event_counts(spark, sf):
    from folioforge.streaming.ingest import windowed_counts

    return windowed_counts(table(spark, sf, "events")).withColumn("total", F.round("total", 6))


