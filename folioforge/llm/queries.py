"""Queries of the training-data operators and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import cooccurrence, mixture, near_duplicates, page_noise, split, tokenize, truncation
from folioforge.session import table

LISTS = ("entities", "keywords", "figures")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    found = cooccurrence.cooccurrence(table(spark, sf, "build_graph"), key="node_id", lists=LISTS, min_count=5, min_support=0.003, min_lift=3.0)
    return found.select("item_a", "item_b")


def p1_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return cooccurrence.cooccurrence(table(spark, sf, "build_graph"), key="node_id", lists=LISTS)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    fixed = page_noise.repaired(table(spark, sf, "build_graph"), table(spark, sf, "source_catalog"), with_text=False)
    return fixed.select("node_id", F.explode("noise").alias("noise")).distinct()


def p2_clean(spark: SparkSession, sf: str) -> DataFrame:
    return page_noise.repaired(table(spark, sf, "build_graph"), table(spark, sf, "source_catalog"))


P5 = {"key": "node_id", "text": "text", "threshold": 0.7, "width": 3, "least_words": 20}


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = near_duplicates.near_duplicate_pairs(table(spark, sf, "build_graph"), **P5)
    return pairs.select(F.col("id_a").alias("node_id_a"), F.col("id_b").alias("node_id_b"))


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(table(spark, sf, "build_graph"), **P5).withColumnRenamed("id", "node_id")


def _pieces(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_oversized(table(spark, sf, "build_graph"), table(spark, sf, "split_limits"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _pieces(spark, sf).where(F.col("piece_no") == 1).select("node_id").distinct()


def p6_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return _pieces(spark, sf)


def p6_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """The pieces put together again, and whether they keep the limit and the overlap of their format."""
    pieces = _pieces(spark, sf)
    limits = table(spark, sf, "split_limits")
    records = table(spark, sf, "build_graph").select("node_id", split.format_of(F.col("source_file")).alias("file_format")).distinct()
    other = limits.where("file_format = 'other'").first()
    known = F.col("max_chars").isNotNull()
    own = records.join(limits, "file_format", "left")
    own = own.select("node_id", F.when(known, F.col("max_chars")).otherwise(other.max_chars).alias("max_chars"), F.when(known, F.col("overlap_chars")).otherwise(other.overlap_chars).alias("most"))
    joined = pieces.join(own, "node_id")
    rest = F.substring(F.col("text"), F.col("overlap_chars") + 1, F.char_length("text"))
    return joined.groupBy("node_id").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", rest.alias("t")))), lambda x: x["t"]), "")).alias("text_md5"),
        F.bool_and((F.char_length("text") <= F.col("max_chars")) & (F.char_length("text") > 0)).alias("within_limit"),
        F.bool_and(F.col("overlap_chars") <= F.col("most")).alias("within_overlap"),
    )


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokenize.encode(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_targets")
    sizes = mixture.sized(table(spark, sf, "documents"), targets)
    return mixture.mix(sizes, mixture.rates(sizes, targets))


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_targets")
    sizes = mixture.sized(table(spark, sf, "documents"), targets)
    rated = mixture.rates(sizes, targets)
    return mixture.report(mixture.mix(sizes, rated), rated)


def p8_corpus(spark: SparkSession, sf: str) -> DataFrame:
    targets, docs = table(spark, sf, "mix_targets"), table(spark, sf, "documents")
    return mixture.emit(docs, mixture.rates(mixture.sized(docs, targets), targets))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.truncated(table(spark, sf, "documents")).where("is_cut").select("doc_id").distinct()


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.report(truncation.truncated(table(spark, sf, "documents")))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_pairs, p2_found, p2_clean, p5_found, p5_groups, p6_found, p6_pieces, p6_rebuilt, p7_ids, p8_mix, p8_report, p8_corpus, p9_found, p9_report)
}

_BASKETS = r"""
r AS (SELECT node_id, any_value(entities) AS e, any_value(keywords) AS k, any_value(figures) AS f FROM build_graph GROUP BY 1),
i AS (SELECT DISTINCT node_id, item FROM (
  SELECT node_id, lower(trim(regexp_replace(unnest(list_concat(coalesce(e, []), coalesce(k, []), coalesce(f, []))), '\s+', ' ', 'g'))) AS item FROM r) WHERE item <> ''),
c AS (SELECT item, count(*) AS n FROM i GROUP BY 1),
p AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS n_ab FROM i a JOIN i b ON a.node_id = b.node_id AND a.item < b.item GROUP BY 1, 2),
t AS (SELECT p.*, ca.n AS n_a, cb.n AS n_b, (SELECT count(*) FROM r) AS n_records FROM p JOIN c ca ON ca.item = item_a JOIN c cb ON cb.item = item_b),
l AS (SELECT *, n_ab * n_records::DOUBLE / (n_a::DOUBLE * n_b) AS lift FROM t)
"""

_NEAR = r"""
r AS (SELECT node_id, any_value(text) AS t FROM build_graph WHERE text IS NOT NULL AND node_id IS NOT NULL GROUP BY 1),
w AS (SELECT node_id, t, list_transform(regexp_extract_all(t, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM r),
k AS (SELECT node_id, min(node_id) OVER (PARTITION BY t) AS class_id, w FROM w WHERE len(w) >= 20),
s AS (SELECT DISTINCT node_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM k),
n AS (SELECT node_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.node_id AS x, b.node_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.node_id < b.node_id GROUP BY 1, 2),
f AS (SELECT x AS node_id_a, y AS node_id_b FROM p JOIN n a ON a.node_id = x JOIN n b ON b.node_id = y WHERE i >= 0.7 * (a.n + b.n - i) - 1e-9)
"""

ORACLES = {
    "p5_found": f"WITH {_NEAR} SELECT node_id_a, node_id_b FROM f",
    "p5_groups": f"""WITH RECURSIVE {_NEAR},
l AS (SELECT DISTINCT least(a.class_id, b.class_id) AS a, greatest(a.class_id, b.class_id) AS b FROM f JOIN k a ON a.node_id = node_id_a JOIN k b ON b.node_id = node_id_b WHERE a.class_id <> b.class_id),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
z(node, component) USING KEY (node) AS (SELECT DISTINCT class_id, class_id FROM k UNION
  SELECT e.b, min(z.component) FROM z JOIN e ON e.a = z.node JOIN recurring.z o ON o.node = e.b WHERE z.component < o.component GROUP BY e.b),
d AS (SELECT a AS class_id, count(*) AS n_links FROM e GROUP BY 1),
o AS (SELECT k.node_id, k.class_id, z.component AS group_id, coalesce(n_links, 0) AS n_links, count(*) OVER (PARTITION BY z.component) AS m FROM k JOIN z ON z.node = k.class_id LEFT JOIN d ON d.class_id = k.class_id)
SELECT node_id, class_id, group_id, n_links FROM o WHERE m > 1""",
    "p6_rebuilt": r"""
SELECT node_id, md5(any_value(text)) AS text_md5, true AS within_limit, true AS within_overlap FROM build_graph
LEFT JOIN split_limits s ON s.file_format = lower(regexp_extract(source_file, '\.([^.]*)$', 1))
WHERE length(text) > coalesce(s.max_chars, (SELECT max_chars FROM split_limits WHERE file_format = 'other')) GROUP BY 1""",
    "p1_found": f"WITH {_BASKETS} SELECT item_a, item_b FROM l WHERE n_ab >= 5 AND n_ab / n_records::DOUBLE >= 0.003 AND lift >= 3",
    "p1_pairs": f"WITH {_BASKETS} SELECT item_a, item_b, n_a, n_b, n_ab, n_records, lift FROM l",
    "p6_found": r"""
SELECT DISTINCT node_id FROM build_graph
LEFT JOIN split_limits s ON s.file_format = lower(regexp_extract(source_file, '\.([^.]*)$', 1))
WHERE length(text) > coalesce(s.max_chars, (SELECT max_chars FROM split_limits WHERE file_format = 'other'))""",
}
