"""Items that appear together: a blocked Gram matrix of binary baskets.

Items get codes; CHUNK records at a time are a sparse 0/1 matrix X by rows, and X' X of every chunk is added up in the task:
the non-zero cells of a product come from the sorted codes of each row, some PAIRS of them at once, and equal cells are
summed before the next. So the work and the memory of a task follow the cells that occur, not the width of the dictionary.
Only sums leave the task, so no record's pairs are ever emitted; sums of all tasks are added by Spark, and the diagonal
gives the marginals. Expected counts under independence are n_a * n_b / N.

A minimum support s bounds the dictionary: at most (mean basket size) / s items can reach it, however large the corpus,
and only those take part. A dictionary beyond `dictionary_items` rows or DICTIONARY_BYTES isn't sent to the tasks; codes then
reach the records by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import one_per_record, squeezed
from folioforge.operators.numbering import number_rows
from folioforge.session import cut_lineage

CHUNK = 4096  # records in one product
PAIRS = 1 << 21  # cells of products that are worked off at once
CELLS = 1 << 22  # sums that a task holds before it hands them over: 64 MB
DICTIONARY_BYTES = 16 << 20


def baskets(records: DataFrame, key: str, lists: Sequence[str]) -> DataFrame:
    """(items array<string>) of each record: distinct normalised items of the lists, null and empty ones dropped.

    Records without items stay, with an empty array. Rows of one key are one record; null keys see one_per_record.
    """
    every = F.concat(*(F.coalesce(F.col(c), F.array().cast("array<string>")) for c in lists))
    items = F.array_distinct(F.filter(F.transform(every, squeezed), lambda x: x.isNotNull() & (x != "")))
    return one_per_record(records.select(F.col(key).alias("k"), items.alias("items")), "k").select("items")


class _Gram:
    """Sums of sparse products."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, rows: np.ndarray, codes: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
        """rows, codes: the non-zero cells of n records, distinct, codes as int64 below 2^31. Yields the sums so far whenever they are too many."""
        order = np.lexsort((codes, rows))
        rows, codes = rows[order], codes[order]
        ends = np.cumsum(np.bincount(rows, minlength=n))
        reach = ends[rows] - np.arange(len(rows))  # each code meets itself and those behind it in its row
        total = np.cumsum(reach)
        at = 0
        while at < len(codes):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
            r = reach[at:to]
            left = np.repeat(np.arange(at, to), r)
            right = left + np.arange(len(left)) - np.repeat(np.cumsum(r) - r, r)
            keys, counts = np.unique(codes[left] << 31 | codes[right], return_counts=True)
            self.parts.append((keys, counts))
            self.held += len(keys)
            if self.held > CELLS:
                self._merge()
                if self.held > CELLS // 2:
                    yield from self.cells()
            at = to

    def _merge(self) -> None:
        if len(self.parts) > 1:
            keys, counts = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.parts = [(keys[first], np.add.reduceat(counts, first))]
            self.held = len(first)

    def cells(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for keys, counts in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 31), pa.array(keys & ((1 << 31) - 1)), pa.array(counts.astype(np.int64))], names=["a", "b", "n"])
        self.parts, self.held = [], 0


def _gram(coded: DataFrame, names: list[str] | None) -> DataFrame:
    """(a, b, n) for codes a <= b. coded: arrays of strings that are looked up in names, or arrays of bigint codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = _Gram()
        known = {name: k for k, name in enumerate(names)} if names is not None else None
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                lists = batch.column(0).slice(start, CHUNK)
                values = lists.flatten()
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                rows = np.repeat(np.arange(len(lists)), sizes)
                if known is not None:
                    told = values.dictionary_encode()
                    code_of = pa.array([known.get(x) for x in told.dictionary.to_pylist()], pa.int64())
                    values = code_of.take(told.indices)
                kept = pc.is_valid(values).to_numpy(zero_copy_only=False)
                codes = pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield from gram.add(rows[kept], codes[kept], len(lists))
        yield from gram.cells()

    return coded.mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def cooccurrence(
    records: DataFrame, *, key: str, lists: Sequence[str], min_count: int = 1, min_support: float = 0.0, min_lift: float = 0.0, dictionary_items: int = 200_000
) -> DataFrame:
    """(item_a, item_b, n_a, n_b, n_ab, n_records, lift) of every two items with item_a < item_b.

    lift = n_ab * N / (n_a * n_b), N counts all records, those without items too. Kept: n_ab >= min_count, n_ab / N >=
    min_support, lift >= min_lift. An empty table, or one without pairs, gives no rows. Extra columns are ignored.
    """
    held = cut_lineage(baskets(records, key, lists))
    total = held.count()
    need = max(min_count, math.ceil(min_support * total - 1e-9))
    counts = held.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n_item")).where(F.col("n_item") >= need)
    counts = cut_lineage(counts)
    spark = records.sparkSession
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("item")), F.lit(0)).alias("bytes")).first()
    if size.n <= dictionary_items and size.bytes <= DICTIONARY_BYTES:
        names = sorted(r.item for r in counts.select("item").collect())
        codes = spark.createDataFrame(list(enumerate(names)), "code bigint, item string")
        cells = _gram(held.select("items"), names)
    else:
        codes = cut_lineage(number_rows(counts.select("item"), "code"))
        numbered = held.withColumn("record", F.monotonically_increasing_id()).select("record", F.explode("items").alias("item"))
        cells = _gram(numbered.join(codes, "item").groupBy("record").agg(F.collect_list("code").alias("codes")).select("codes"), None)
    cells = cut_lineage(cells)
    single = cells.where(F.col("a") == F.col("b")).select(F.col("a").alias("code"), "n").join(codes, "code")
    side = lambda s: single.select(F.col("code").alias(s), F.col("item").alias(f"item_{s}"), F.col("n").alias(f"n_{s}"))
    pairs = cells.where((F.col("a") < F.col("b")) & (F.col("n") >= need)).withColumnRenamed("n", "n_ab")
    out = pairs.join(side("a"), "a").join(side("b"), "b")
    swap = F.col("item_a") > F.col("item_b")
    out = out.select(
        F.least("item_a", "item_b").alias("item_a"),
        F.greatest("item_a", "item_b").alias("item_b"),
        F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
        F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
        "n_ab",
        F.lit(total).cast("bigint").alias("n_records"),
    )
    out = out.withColumn("lift", F.col("n_ab") * F.col("n_records").cast("double") / (F.col("n_a").cast("double") * F.col("n_b")))
    return out.where(F.col("lift") >= min_lift)
