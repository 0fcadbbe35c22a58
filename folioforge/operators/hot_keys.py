"""A few keys holding most records: per-key counts whose tasks all take about the same time.

Keys are never used to place rows. Rows are split evenly; each split encodes the keys it meets in a dictionary of its own
and adds into dense numpy arrays with bincount, so a key of a third of all rows costs each split one array cell. The
arrays of the splits, a few entries for each key, are then summed by a distributed reduction. Distinct edges and nodes are
first made distinct by a shuffle on (key, value), which spreads a hot key over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut_lineage


def dense_counts(df: DataFrame, keys: Sequence[str], measures: Sequence[str], *, flush_keys: int = 1 << 20) -> DataFrame:
    """Sum of each measure (bigint columns of df, null counts as 0) for each key, keys null-safe.

    flush_keys bounds the dictionary of a split: a split that meets more keys hands over its arrays and starts afresh;
    the reduction adds both, so the result is whole.
    """
    keys, measures = list(keys), list(measures)
    names = [*keys, *measures]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple, int] = {}
        totals = np.zeros((len(measures), 1024), np.int64)

        def block() -> pa.RecordBatch:
            columns = [pa.array([k[j] for k in codes], pa.string()) for j in range(len(keys))]
            columns += [pa.array(totals[j, : len(codes)]) for j in range(len(measures))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            # the dictionary of the batch, column by column, then one code for each combination
            local = np.zeros(batch.num_rows, np.int64)
            uniques = []
            for j in range(len(keys)):
                part, values = pd.factorize(batch.column(j).to_numpy(zero_copy_only=False), use_na_sentinel=False)
                local = local * len(values) + part
                uniques.append(values)
            seen, local = np.unique(local, return_inverse=True)
            parts = []
            rest = seen
            for values in reversed(uniques):
                parts.append([None if v is None or v != v else v for v in values[rest % len(values)]])
                rest = rest // len(values)
            target = np.array([codes.setdefault(k, len(codes)) for k in zip(*reversed(parts))], np.int64)
            if len(codes) > totals.shape[1]:
                totals = np.concatenate((totals, np.zeros((len(measures), max(len(codes), totals.shape[1])), np.int64)), axis=1)
            for j in range(len(measures)):
                weight = batch.column(len(keys) + j).fill_null(0).to_numpy(zero_copy_only=False)
                # bincount adds in float64: exact below 2**53 for one batch
                totals[j, target] += np.bincount(local, weights=weight, minlength=len(seen)).astype(np.int64)
            if len(codes) >= flush_keys:
                yield block()
                codes, totals = {}, np.zeros((len(measures), 1024), np.int64)
        if codes:
            yield block()

    schema = ", ".join([*(f"`{k}` string" for k in keys), *(f"`{m}` bigint" for m in measures)])
    partial = df.select(*(F.col(k).cast("string").alias(k) for k in keys), *(F.col(m).cast("bigint").alias(m) for m in measures)).mapInArrow(run, schema)
    return partial.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _codes_tell(names: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the 8-byte hashes of the rows of names, which are distinct, are so too."""
    size = names.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.xxhash64(*columns)).alias("codes")).first()
    return size.n == size.codes


def key_profile(edges: DataFrame) -> DataFrame:
    """(edge_type, shared_item, n_rows, n_edges, n_nodes) of every key with neither part null nor empty.

    n_rows counts repeated rows; n_edges counts distinct unordered node pairs (an edge with a null end has no pair and is
    not counted); n_nodes counts distinct non-null ends. Columns beyond node1, node2, edge_type and shared_item are ignored.
    An empty table gives no rows. Keys and nodes move as codes of 8 bytes; should two of them have the same one, as they are.
    """
    keys = ["edge_type", "shared_item"]
    valid = edges.where(_present(F.col("edge_type")) & _present(F.col("shared_item"))).select(*keys, "node1", "node2")
    named = cut_lineage(valid.select(*keys).distinct())
    nodes = valid.select(F.explode(F.array("node1", "node2")).alias("node")).where(F.col("node").isNotNull()).distinct()
    if not (_codes_tell(named, keys) and _codes_tell(nodes, ["node"])):
        return _profile(valid, keys)
    code = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c)
    counts = _profile(valid.select(F.xxhash64(*keys).alias("key"), code("node1"), code("node2")), ["key"])
    names = named.withColumn("key", F.xxhash64(*keys).cast("string"))
    return counts.join(names, "key").select(*keys, "n_rows", "n_edges", "n_nodes")


def _profile(valid: DataFrame, keys: Sequence[str]) -> DataFrame:
    ordered = F.when(F.col("node1").isNotNull() & F.col("node2").isNotNull(), F.least("node1", "node2"))
    # repeated and reversed edges collapse here; the hash covers the pair, so no key is placed as a whole
    pairs = (
        valid.select(*keys, F.coalesce(ordered, "node1").alias("lo"), F.when(ordered.isNotNull(), F.greatest("node1", "node2")).otherwise(F.col("node2")).alias("hi"))
        .groupBy(*keys, "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    zero = F.lit(0).cast("bigint")
    whole = F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), 1).otherwise(0).cast("bigint")
    by_pair = pairs.select(*keys, "n_rows", whole.alias("n_edges"), zero.alias("n_nodes"))
    by_node = (
        pairs.select(*keys, F.explode(F.array("lo", "hi")).alias("node"))
        .where(F.col("node").isNotNull())
        .groupBy(*keys, "node")
        .agg(zero.alias("n_rows"))
        .select(*keys, "n_rows", zero.alias("n_edges"), F.lit(1).cast("bigint").alias("n_nodes"))
    )
    return dense_counts(by_pair.unionByName(by_node), keys, ["n_rows", "n_edges", "n_nodes"])


def row_counts(edges: DataFrame) -> DataFrame:
    """(edge_type, shared_item, n_rows) of every key, null and empty ones too: rows are read where they lie, nothing but
    the arrays of the splits moves."""
    return dense_counts(edges.select("edge_type", "shared_item", F.lit(1).cast("bigint").alias("n_rows")), ["edge_type", "shared_item"], ["n_rows"])


def hot_keys(edges: DataFrame, least_share: float = 0.02) -> DataFrame:
    """(edge_type, shared_item, n_rows, share) of the keys that hold at least least_share of all rows of edges.

    The total counts every row, those of null keys too. At most 1 / least_share keys can qualify. Rows of keys with a null
    or empty part never do. An empty table gives no rows.
    """
    total = edges.select(F.count(F.lit(1))).scalar()  # a scan of no column
    counts = row_counts(edges).where(_present(F.col("edge_type")) & _present(F.col("shared_item")))
    return counts.withColumn("share", F.col("n_rows") / total).where(F.col("share") >= F.lit(float(least_share)))
