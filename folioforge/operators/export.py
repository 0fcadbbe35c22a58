"""Node and edge tables for bulk import, and their quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_nodes(nodes: DataFrame, export_name: str, most: int = 1000) -> DataFrame:
    """Rows of the node file: id with the export's name in front, text without NUL and of at most `most` characters, lists joined by `, `.

    nodes: unique_id, text, entities, keywords, figures, parent_id, source_file. Null fields become empty. Rows of one id count once.
    """
    joined = lambda c: F.coalesce(F.concat_ws(", ", c), F.lit(""))
    text = F.substring(F.regexp_replace(F.coalesce("text", F.lit("")), "\x00", ""), 1, most)
    return nodes.where(F.col("unique_id").isNotNull()).dropDuplicates(["unique_id"]).select(
        F.concat(F.lit(f"{export_name}_"), F.col("unique_id")).alias("id"), F.lit("Node").alias("node_label"), F.lit(f"{export_name}.gml").alias("source_file"), text.alias("text"),
        joined("entities").alias("entities"), joined("keywords").alias("keywords"), joined("figures").alias("figures"),
        F.coalesce("parent_id", F.lit("")).alias("parent_id"), F.col("unique_id").alias("label"), F.coalesce("source_file", F.lit("")).alias("original_source_file"),
    )


def export_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """(start_id, end_id, relationship_type, weight) of edges (src, dst, edge_type, weight) whose ends are both in ids (id)."""
    known = ids.select("id").distinct()
    kept = edges.join(known.withColumnRenamed("id", "src"), "src", "left_semi").join(known.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return kept.select(F.col("src").alias("start_id"), F.col("dst").alias("end_id"), F.col("edge_type").alias("relationship_type"), F.col("weight").cast("double").alias("weight"))


def write_by_type(edges: DataFrame, path: str) -> None:
    """One folder of CSV files for each relationship type; the type stands in the folder's name only."""
    edges.write.mode("overwrite").option("header", True).option("escape", '"').partitionBy("relationship_type").csv(path)


def typed_header(columns: list[str], types: dict[str, str]) -> list[str]:
    """Column names with their `:TYPE` suffixes."""
    return [f"{c}:{types[c]}" if c in types else c for c in columns]


def untyped_header(columns: list[str]) -> list[str]:
    """Column names without `:TYPE` suffixes; one that is a suffix only keeps its type in lower case."""
    return [c.split(":", 1)[0] or c[1:].lower() for c in columns]


def quality_counts(edges: DataFrame) -> DataFrame:
    """One row of counts over raw edges: rows, missing ends, types and items, repeated rows and loops."""
    whole = edges.groupBy("node1", "node2", "edge_type", "shared_item").agg(F.count(F.lit(1)).alias("n"))  # first level, so no distinct over all rows
    times = lambda c: F.sum(F.when(F.col(c).isNull() | (F.col(c) == ""), F.col("n")).otherwise(0))
    zero = F.lit(0).cast("bigint")
    return whole.agg(
        F.coalesce(F.sum("n"), zero).alias("n_rows"), F.coalesce(times("node1") + times("node2"), zero).alias("n_missing_ends"), F.coalesce(times("edge_type"), zero).alias("n_missing_type"),
        F.coalesce(times("shared_item"), zero).alias("n_missing_item"), F.coalesce(F.sum(F.col("n") - 1), zero).alias("n_repeated"), F.coalesce(F.sum(F.when(F.col("node1") == F.col("node2"), F.col("n")).otherwise(0)), zero).alias("n_loops"),
    )
