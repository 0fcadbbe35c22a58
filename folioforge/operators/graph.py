"""Graph statistics, merging, lookup and paths over node and edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import cut_lineage


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, degree) of every node; a loop counts twice. nodes: node; edges: src, dst."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("node").distinct().join(ends, "node", "left").select("node", F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree"))


def degree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, average, largest and least degree, isolated nodes; zeros for an empty graph."""
    zero = F.lit(0).cast("bigint")
    return degrees(nodes, edges).agg(
        F.count(F.lit(1)).alias("n_nodes"), F.coalesce(F.avg("degree"), F.lit(0.0)).alias("avg_degree"), F.coalesce(F.max("degree"), zero).alias("max_degree"),
        F.coalesce(F.min("degree"), zero).alias("min_degree"), F.count_if(F.col("degree") == 0).alias("n_isolated"),
    )


def isolated_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without an edge: two anti joins, no union of the ends."""
    left = nodes.select("node").distinct()
    return left.join(edges.select(F.col("src").alias("node")), "node", "left_anti").join(edges.select(F.col("dst").alias("node")), "node", "left_anti")


def compose(rows: DataFrame, key: str, order: str, attributes: Sequence[str]) -> DataFrame:
    """One row for each key: every attribute from the last graph, by `order`, that gives it a value; empty counts as none."""
    last = [F.max_by(F.col(a), F.when(F.col(a) != "", F.struct(F.col(order), F.col(a)))).alias(a) for a in attributes]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*last)


MOST_GRAPHS = 2_000


def merge_with_prefix(graphs: DataFrame, graph: str, node: str) -> DataFrame:
    """(graph, node, merged_id): graphs are merged in ascending order of name; one that holds an id already taken gets its
    name as a prefix on all of its ids.

    A graph depends on those before it only by which of them it shares ids with: one pass finds these pairs of graphs, and
    the order is followed on them. At most MOST_GRAPHS graphs may share ids. Rows with a null graph or id are dropped,
    repeated ones count once.
    """
    pairs = cut_lineage(graphs.where(F.col(node).isNotNull() & F.col(graph).isNotNull()).select(graph, node).distinct())
    # the graphs of an id as one set; few sets differ, and only they are paired
    sets = pairs.groupBy(node).agg(F.array_sort(F.collect_set(graph)).alias("held")).where(F.size("held") > 1).select("held").distinct()
    later = sets.select("held", F.posexplode("held").alias("k", "later")).select("later", F.explode(F.slice("held", F.lit(1), F.col("k"))).alias("earlier")).distinct()
    met = cut_lineage(later)
    if met.select("later").distinct().limit(MOST_GRAPHS + 1).count() > MOST_GRAPHS:
        raise ValueError(f"more than {MOST_GRAPHS} graphs with shared ids")
    earlier: dict[str, list[str]] = {}
    for r in met.collect():  # at most MOST_GRAPHS squared, halved
        earlier.setdefault(r.later, []).append(r.earlier)
    clash: set[str] = set()
    for name in sorted(earlier, key=lambda x: x.encode()):
        if any(e not in clash for e in earlier[name]):
            clash.add(name)
    hit = F.col(graph).isin(*clash) if clash else F.lit(False)
    return pairs.withColumn("merged_id", F.when(hit, F.concat(F.col(graph), F.lit("_"), F.col(node))).otherwise(F.col(node)))


def resolve_endpoints(ends: DataFrame, registry: DataFrame) -> DataFrame:
    """ends (end_id, original_id, hint) with status and final_id.

    registry: original_id, final_id, source_file. One match: resolved. More: those of the hinted file decide, if they are
    one. None: missing; otherwise ambiguous. final_id is null unless resolved.
    """
    known = registry.select("original_id", "final_id", "source_file").distinct().groupBy("original_id", "source_file").agg(F.count(F.lit(1)).alias("n_file"), F.min("final_id").alias("file_final"))
    total = known.groupBy("original_id").agg(F.sum("n_file").alias("n_all"), F.min("file_final").alias("any_final"))
    hinted = known.withColumnRenamed("source_file", "hint")
    out = ends.join(total, "original_id", "left").join(hinted, ["original_id", "hint"], "left")
    status = F.when(F.col("n_all").isNull(), "missing").when((F.col("n_all") == 1) | (F.col("n_file") == 1), "resolved").otherwise("ambiguous")
    final = F.when(F.col("n_all") == 1, F.col("any_final")).when(F.col("n_file") == 1, F.col("file_final"))
    return out.select("end_id", "original_id", "hint", status.alias("status"), final.alias("final_id"))


def resolve_edges(edges: DataFrame, hints: DataFrame, registry: DataFrame) -> DataFrame:
    """edges (node1, node2, rest) with status, start_id and end_id: both ends resolved against the registry.

    hints: original_id, hint, one row each id at most; registry as for resolve_endpoints. The status is that of node1, or
    of node2 if node1 is resolved; a null or empty end is missing. The ids are null unless both ends are resolved. Each
    distinct end is resolved once.
    """
    ends = edges.select(F.explode(F.array("node1", "node2")).alias("original_id")).where("original_id <> ''").distinct()
    known = cut_lineage(resolve_endpoints(ends.join(hints, "original_id", "left").withColumn("end_id", F.col("original_id")), registry).select("original_id", "status", "final_id"))
    of = lambda c, s: known.select(F.col("original_id").alias(c), F.col("status").alias(f"__s{s}"), F.col("final_id").alias(f"__f{s}"))
    both = edges.join(of("node1", 1), "node1", "left").join(of("node2", 2), "node2", "left")
    one = lambda s: F.coalesce(F.col(f"__s{s}"), F.lit("missing"))
    status = F.when(one(1) != "resolved", one(1)).otherwise(one(2))
    final = lambda s: F.when(status == "resolved", F.col(f"__f{s}"))
    return both.select(*edges.columns, status.alias("status"), final(1).alias("start_id"), final(2).alias("end_id"))


def merge_aliases(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """(src, dst, weight) with ends replaced by their canonical ids, weights added up, loops dropped. aliases: alias, canonical."""
    one = aliases.groupBy("alias").agg(F.min("canonical").alias("canonical"))
    a = one.select(F.col("alias").alias("src"), F.col("canonical").alias("ca"))
    b = one.select(F.col("alias").alias("dst"), F.col("canonical").alias("cb"))
    moved = edges.join(a, "src", "left").join(b, "dst", "left").select(F.coalesce("ca", "src").alias("x"), F.coalesce("cb", "dst").alias("y"), "weight")
    return moved.where("x <> y").groupBy(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst")).agg(F.sum("weight").alias("weight"))


def merge_alias_nodes(nodes: DataFrame, aliases: DataFrame, attributes: Sequence[str], node: str = "node") -> DataFrame:
    """(node, n_merged, attributes as arrays): nodes under their canonical ids, each attribute combined: the distinct values
    of all aliases in ascending order, null and empty ones left out. aliases: alias, canonical; others keep their id."""
    one = aliases.groupBy("alias").agg(F.min("canonical").alias("canonical")).withColumnRenamed("alias", node)
    named = nodes.where(F.col(node).isNotNull()).join(one, node, "left").withColumn("__to", F.coalesce("canonical", node))
    held = [F.array_sort(F.collect_set(F.when(F.col(a).cast("string") != "", F.col(a)))).alias(a) for a in attributes]  # as many as aliases
    return named.groupBy(F.col("__to").alias(node)).agg(F.count_distinct(F.col(node)).alias("n_merged"), *held)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing with the rows of new whose keys, null-safe, it lacks; of rows of new with equal keys one stays, the least by all columns."""
    both = existing.withColumn("__age", F.lit(0)).unionByName(new.withColumn("__age", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy("__age", *(c for c in both.columns if c not in (*keys, "__age")))
    return both.withColumn("__k", F.row_number().over(order)).where("__k = 1 or __age = 0").drop("__k", "__age")


def trails(edges: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """(start, finish, n_hops, weight) of every undirected trail of 1 to hops edges from the start nodes, no edge used twice.

    edges: src, dst, weight, one row each pair; starts: node. The start filter comes first, each hop is one equi-join on
    the end reached; the number of trails grows with the hops, so the caller bounds them.
    """
    known = edges.withColumn("e", F.concat_ws("\x01", "src", "dst"))
    steps = known.select(F.col("src").alias("at"), F.col("dst").alias("next"), "e", F.col("weight").alias("w"))
    steps = steps.unionByName(known.where("src <> dst").select(F.col("dst").alias("at"), F.col("src").alias("next"), "e", F.col("weight").alias("w")))
    now = starts.select(F.col("node").alias("start"), F.col("node").alias("at"), F.array().cast("array<string>").alias("used"), F.lit(0).cast("bigint").alias("total"))
    out = None
    for k in range(1, hops + 1):
        now = now.join(steps, "at").where(~F.array_contains("used", F.col("e"))).select("start", F.col("next").alias("at"), F.array_append("used", F.col("e")).alias("used"), (F.col("total") + F.col("w")).alias("total"))
        found = now.select("start", F.col("at").alias("finish"), F.lit(k).alias("n_hops"), F.col("total").alias("weight"))
        out = found if out is None else out.unionByName(found)
    return out


def trails_between(edges: DataFrame, starts: DataFrame, ends: DataFrame, hops: int) -> DataFrame:
    """(start, finish, n_hops, weight) of every undirected trail of 1 to hops edges from a node of starts to one of ends.

    The trails of trails() that finish in ends (node), without walking all others: a trail is a front half walked from its
    start and a back half walked from its end that meet in a node and have no edge in common.
    """
    numbered = cut_lineage(edges.select("src", "dst", "weight").withColumn("e", F.monotonically_increasing_id()))
    steps = numbered.select(F.col("src").alias("at"), F.col("dst").alias("next"), "e", F.col("weight").alias("w"))
    steps = steps.unionByName(numbered.where("src <> dst").select(F.col("dst").alias("at"), F.col("src").alias("next"), "e", F.col("weight").alias("w")))

    def walks(first: DataFrame, most: int) -> list[DataFrame]:
        out = [first.select(F.col("node").alias("origin"), F.col("node").alias("at"), F.array().cast("array<bigint>").alias("used"), F.lit(0).cast("bigint").alias("total")).distinct()]
        for _ in range(most):
            on = out[-1].join(steps, "at").where(~F.array_contains("used", F.col("e")))
            out.append(on.select("origin", F.col("next").alias("at"), F.array_append("used", F.col("e")).alias("used"), (F.col("total") + F.col("w")).alias("total")))
        return out

    front, back = walks(starts, (hops + 1) // 2), walks(ends, hops // 2)
    out = None
    for k in range(1, hops + 1):
        f = front[(k + 1) // 2].select(F.col("origin").alias("start"), "at", F.col("used").alias("u1"), F.col("total").alias("t1"))
        b = back[k // 2].select(F.col("origin").alias("finish"), "at", F.col("used").alias("u2"), F.col("total").alias("t2"))
        met = f.join(b, "at").where(~F.arrays_overlap("u1", "u2"))
        found = met.select("start", "finish", F.lit(k).alias("n_hops"), (F.col("t1") + F.col("t2")).alias("weight"))
        out = found if out is None else out.unionByName(found)
    return out
