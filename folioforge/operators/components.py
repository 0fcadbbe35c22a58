"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut_lineage


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; component is the least node of it.

    Alternates two local steps until nothing changes: each node links its larger neighbours to its least neighbour, then
    each node links its smaller neighbours to the least one. Rounds grow with the logarithm of the longest path. Neighbour
    lists are never collected: the least neighbour comes from a hash aggregation and meets the edges in a join. Every
    round is written to the shared checkpoint folder. Nodes other than whole numbers go by a hash of 8 bytes meanwhile; if
    two of them share one, by themselves. Edges with a null end and loops carry no link; a node that has only loops is a
    component of its own. Repeated and reversed edges count once.
    """
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    nodes = both.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    if both.schema["u"].dataType.simpleString() in ("bigint", "int"):
        return _named(nodes, _settled(both, max_rounds), "node")
    held = cut_lineage(nodes.withColumn("id", F.xxhash64("node")))
    size = held.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")).first()
    if size.n != size.ids:
        return _named(held, _settled(both, max_rounds), "node")
    return _named(held, _settled(both.select(F.xxhash64("u").alias("u"), F.xxhash64("v").alias("v")), max_rounds), "id")


def _named(nodes: DataFrame, settled: DataFrame, key: str) -> DataFrame:
    """(node, component) of nodes (node, key) from the roots of their keys: the least node of those with one root."""
    rooted = nodes.join(settled.withColumnRenamed("u", key), key, "left").select("node", F.coalesce("root", key).alias("root"))
    least = rooted.groupBy("root").agg(F.min("node").alias("component"))
    return rooted.join(least, "root").select("node", "component")


def _settled(both: DataFrame, max_rounds: int) -> DataFrame:
    """(u, root) of every node that isn't a root, for edges (u, v)."""
    now = cut_lineage(both.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def check(e: DataFrame) -> tuple:
        # the edges settle when every one leads straight to a least node: their number and hash stay the same
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = check(now)
    for _ in range(max_rounds):
        sym = now.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        floor = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(floor, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = cut_lineage(small.where("u <> v").distinct())
        after = check(now)
        if after == before:
            return now.withColumnRenamed("v", "root")
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
