"""Approximate nearest neighbours: an inverted file of cells around fitted centres.

The centres are fitted on a bounded sample; every vector is put in the cell of its nearest centre; a query reads the rows of
its nearest cells only, by a join on the cell. With as many probes as cells the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import vector


def fit_centres(vectors: DataFrame, n_cells: int = 256, *, key: str = "vec_id", embedding: str = "embedding", sample: int = 50_000, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centres (cells x dimension) by Lloyd's rounds over at most `sample` vectors, those of the least hash of their key.

    Fewer vectors than cells give as many cells as vectors; null vectors are left out, vectors of another length than the
    first one too. No vectors raise an error.
    """
    rows = vectors.where(F.col(embedding).isNotNull()).select(F.xxhash64(F.lit(seed), key).alias("h"), embedding).orderBy("h").limit(sample).collect()
    if not rows:
        raise ValueError("no vectors to fit centres on")
    x = np.array([r[1] for r in rows if len(r[1]) == len(rows[0][1])], np.float64)
    centres = x[np.linspace(0, len(x) - 1, min(n_cells, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest_centres(x, centres, 1)[:, 0]
        size = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        some = size > 0
        centres[some] = sums[some] / size[some, None]
    return centres


def _nearest_centres(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    d = (centres**2).sum(1)[None, :] - 2 * x @ centres.T
    return np.argsort(d, axis=1, kind="stable")[:, :n] if n > 1 else d.argmin(axis=1)[:, None]


def cells_of(vectors: DataFrame, centres: np.ndarray, *, key: str = "vec_id", embedding: str = "embedding", n: int = 1) -> DataFrame:
    """(key, embedding, cell) with the n nearest cells of every vector, a row each: the index, if n is 1. A narrow map; vectors
    that are null or of another length are left out."""
    n = min(n, len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = batch.filter(pa.array(np.array(batch.column(1).value_lengths().fill_null(0)) == centres.shape[1]))
            if fit.num_rows:
                x = np.asarray(fit.column(1).flatten(), np.float64).reshape(-1, centres.shape[1])
                cells = _nearest_centres(x, centres, n)
                rows = pa.array(np.repeat(np.arange(fit.num_rows), n))
                yield pa.RecordBatch.from_arrays([fit.column(0).take(rows), fit.column(1).take(rows), pa.array(cells.ravel().astype(np.int32))], names=["k", "e", "cell"])

    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, embedding)]
    return vectors.select(key, embedding).mapInArrow(run, f"k {kinds[0]}, e {kinds[1]}, cell int").toDF(key, embedding, "cell")


def probe(index: DataFrame, queries: DataFrame, centres: np.ndarray, k: int, *, n_probe: int = 32, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, key, distance) of the k nearest rows in the n_probe nearest cells of each query (query_id, embedding), by
    squared L2, ties by key. A cell of many rows is an ordinary skewed join key, which adaptive execution splits."""
    asked = cells_of(queries, centres, key="query_id", embedding=embedding, n=n_probe).withColumnRenamed(embedding, "q")
    met = index.join(asked, "cell").select("query_id", key, F.round(vector.squared_l2(F.col(embedding), F.col("q")), 9).alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", key))  # cut to k rows before the shuffle
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", key, "distance")
