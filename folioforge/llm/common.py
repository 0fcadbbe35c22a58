"""Helpers of the operators in this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_record(df: DataFrame, key: str) -> DataFrame:
    """Rows loaded again collapse into one; rows whose key is null can't be matched and are each a record."""
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return df.withColumn("__own", own).dropDuplicates([key, "__own"]).drop("__own")


def squeezed(c: Column) -> Column:
    """Trimmed, runs of Unicode white space as one space, lower case."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Bits that a hash filter may have: 16 MB at most. Hashes get 16 bits each up to that, fewer beyond it.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
PROBES = 3


def _probes(h: np.ndarray, n_bits: int) -> list[np.ndarray]:
    x = h.view(np.uint64)
    return [(mix64(x + np.uint64(k + 1)) & np.uint64(n_bits - 1)).astype(np.int64) for k in range(PROBES)]


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter, as bytes, of the bigint hashes in the one column of `hashes`: bounded in size, whatever their number."""
    n_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * hashes.count() - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_probes(h, n_bits))))], names=["bit"])

    at = hashes.mapInArrow(run, "bit bigint").select(F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket"), F.bitmap_bit_position(F.col("bit") + 1).alias("at"))
    held = np.zeros(n_bits // 8, np.uint8)
    for r in at.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).collect():  # n_bits / 8 bytes in all
        part = np.frombuffer(r.bits, np.uint8)
        start = (r.bucket - 1) * len(part)
        held[start : start + len(part)] = part
    return held


def passes(h: pa.Array, held: np.ndarray) -> np.ndarray:
    """Whether each hash is in the filter; one that was put in always is."""
    h = h.to_numpy(zero_copy_only=False)
    there = np.ones(len(h), bool)
    for at in _probes(h, 8 * len(held)):
        there &= (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return there
