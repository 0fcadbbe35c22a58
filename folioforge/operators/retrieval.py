"""Vector search, full-text search, reranking and context assembly."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import vector
from folioforge.operators.numbering import number_rows
from folioforge.session import cut_lineage

METRICS = {"l2sq": vector.squared_l2, "cosine": lambda a, b: 1 - vector.cosine(a, b), "dot": lambda a, b: -vector.dot(a, b)}


def nearest(vectors: DataFrame, query: Sequence[float], k: int, *, metric: str = "l2sq", key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k rows nearest to one query vector with `distance`, ascending, ties by key: one pass, a top-k in each task.

    k beyond the table gives all rows; null vectors and vectors of another length are left out.
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    fit = vectors.where(F.size(embedding) == len(query))
    return fit.withColumn("distance", METRICS[metric](F.col(embedding), q)).orderBy("distance", key).limit(k)


class _Best:
    """The k nearest rows so far for each query of a block."""

    def __init__(self, matrix: np.ndarray, k: int) -> None:
        self.matrix, self.k = matrix, k
        self.keys, self.dist = np.zeros((len(matrix), 0), np.int64), np.zeros((len(matrix), 0))

    def add(self, keys: pa.Array, vectors: pa.Array) -> None:
        """Vectors of another length, and null ones, are passed over."""
        width = self.matrix.shape[1]
        fit = pa.array(np.array(vectors.value_lengths().fill_null(0)) == width)
        keys, vectors = keys.filter(fit), vectors.filter(fit)
        if len(keys) == 0:
            return
        x = np.asarray(vectors.flatten(), np.float64).reshape(-1, width)
        d = (self.matrix**2).sum(1)[:, None] - 2 * self.matrix @ x.T + (x**2).sum(1)[None, :]
        keys = np.concatenate((self.keys, np.broadcast_to(np.asarray(keys, np.int64), d.shape)), axis=1)
        dist = np.concatenate((self.dist, np.round(np.maximum(d, 0), 9)), axis=1)
        if dist.shape[1] > 4 * self.k:  # all up to the k-th distance, then the ties in order
            last = np.partition(dist, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            most = int((dist <= last).sum(axis=1).max())
            order = np.argpartition(dist, most - 1, axis=1)[:, :most] if most < dist.shape[1] else np.broadcast_to(np.arange(dist.shape[1]), dist.shape)
            keys, dist = np.take_along_axis(keys, order, 1), np.take_along_axis(dist, order, 1)
        order = np.lexsort((keys, dist), axis=1)[:, : self.k]
        self.keys, self.dist = np.take_along_axis(keys, order, 1), np.take_along_axis(dist, order, 1)

    def rows(self, ids: np.ndarray) -> list[pa.Array]:
        return [pa.array(np.repeat(ids, self.keys.shape[1])), pa.array(self.keys.ravel()), pa.array(self.dist.ravel())]


FOUND = "query_id bigint, k bigint, distance double"
ROWS = 50_000  # vectors of a tile


def nearest_for_all(vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "vec_id", embedding: str = "embedding", block: int = 2048) -> DataFrame:
    """(query_id, rank, key, distance) of the k nearest vectors by squared L2 for each query (query_id, embedding), ties by key.

    One block of queries goes to all tasks and meets the vectors where they lie. More queries are tiled: blocks of `block`
    queries against blocks of some ROWS vectors, each pair of them a matrix product of its own, so nothing grows with
    either side. Only k rows a query leave a task or tile. The first query's length counts; null vectors and those of
    another length are passed over.
    """
    held = queries.where(F.col(embedding).isNotNull()).select(F.col("query_id").cast("bigint").alias("query_id"), F.col(embedding).alias("q"))
    rows = vectors.where(F.col(embedding).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(embedding).alias("v"))
    first = held.limit(block + 1).collect()
    if len(first) <= block:
        ids, matrix = np.array([r[0] for r in first], np.int64), np.array([r[1] for r in first], np.float64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Best(matrix, k)
            for batch in batches:
                best.add(batch.column(0), batch.column(1))
            if best.keys.shape[1]:
                yield pa.RecordBatch.from_arrays(best.rows(ids), names=["query_id", "k", "distance"])

        found = rows.mapInArrow(run, FOUND) if first else rows.select(F.lit(0).cast("bigint").alias("query_id"), "k", F.lit(0.0).alias("distance")).limit(0)
    else:
        n_q, n_v = (max(1, -(-df.count() // n)) for df, n in ((held, block), (rows, ROWS)))
        dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        a = held.select(dealt("query_id", n_q).alias("i"), every(n_v).alias("j"), F.lit(True).alias("asks"), F.col("query_id").alias("id"), F.col("q").alias("x"))
        b = rows.select(every(n_q).alias("i"), dealt("k", n_v).alias("j"), F.lit(False).alias("asks"), F.col("k").alias("id"), F.col("v").alias("x"))

        def tile(part: pa.Table) -> pa.Table:
            asks, own = part.filter(part.column("asks")).combine_chunks(), part.filter(pc.invert(part.column("asks"))).combine_chunks()
            none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["query_id", "k", "distance"])
            if not len(asks) or not len(own):
                return none
            best = _Best(np.array(asks.column("x").to_pylist(), np.float64), k)
            column = own.column("x").chunk(0)
            for start in range(0, len(own), 8192):
                best.add(own.column("id").chunk(0).slice(start, 8192), column.slice(start, 8192))
            return pa.table(best.rows(asks.column("id").to_numpy()), names=none.column_names)

        found = a.unionByName(b).groupBy("i", "j").applyInArrow(tile, FOUND)
    w = Window.partitionBy("query_id").orderBy("distance", "k")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", F.col("k").alias(key), "distance")


def by_ids(table: DataFrame, ids: Sequence[int], key: str) -> DataFrame:
    """Rows of the ids asked for with their `position` in the request from 0; unknown ids are skipped, repeated ones repeat."""
    wanted = table.sparkSession.createDataFrame([(int(x), k) for k, x in enumerate(ids)], f"{key} bigint, position int")
    return table.join(wanted, key)


def append_vectors(existing: DataFrame, new: DataFrame, dimension: int, *, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """existing with the rows of new under ids that go on from the largest one; a vector of another length is an error."""
    start = F.coalesce(existing.select(F.max(key)).scalar(), F.lit(-1))
    checked = F.when(F.size(embedding) == dimension, F.col(embedding)).otherwise(F.raise_error(F.concat(F.lit(f"dimension is not {dimension}: "), F.size(embedding))))
    numbered = number_rows(new.drop(key), "__n").withColumn(key, start + 1 + F.col("__n")).withColumn(embedding, checked)
    return existing.unionByName(numbered.drop("__n"), allowMissingColumns=True)


def centroids(vectors: DataFrame, group: str, embedding: str = "embedding") -> DataFrame:
    """(group, position, mean) of the mean vector of each group, position from 0."""
    return vectors.select(group, F.posexplode(embedding).alias("position", "x")).groupBy(group, "position").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def terms_of(text: Column) -> Column:
    """Lower-case runs of two or more letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def _count_of(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda x: x == F.lit(term)))


def bm25(docs: DataFrame, query: Sequence[str], *, key: str, text: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) of documents with at least one query term. Statistics cover all documents with a non-null text.

    Texts are cut into terms once: their length and the counts of the terms asked for, a few numbers a document, are
    written to the checkpoint folder; statistics and scores are read from there.
    """
    asked = [t.lower() for t in dict.fromkeys(query)]
    words = terms_of(F.col(text))
    counted = docs.where(F.col(text).isNotNull()).select(F.col(key), F.size(words).alias("n_terms"), *(_count_of(words, t).alias(f"tf{j}") for j, t in enumerate(asked)))
    counted = cut_lineage(counted)
    stats = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("n_terms").alias("avg"), *(F.count_if(F.col(f"tf{j}") > 0).alias(f"df{j}") for j in range(len(asked)))).first()
    score = F.lit(0.0)
    for j in range(len(asked)):
        idf = float(np.log(1 + (stats.n - stats[f"df{j}"] + 0.5) / (stats[f"df{j}"] + 0.5)))
        tf = F.col(f"tf{j}").cast("double")
        score = score + F.lit(idf) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("n_terms") / F.lit(float(stats.avg or 1.0))))
    return counted.where(" or ".join(f"tf{j} > 0" for j in range(len(asked))) or "false").select(key, score.alias("score"))


def tfidf(docs: DataFrame, *, group: Sequence[str], key: str, text: str) -> DataFrame:
    """(group, key, term, weight): smooth inverse document frequency within the group, rows of length 1."""
    tf = docs.select(*group, key, F.explode(terms_of(F.col(text))).alias("term")).groupBy(*group, key, "term").agg(F.count(F.lit(1)).alias("tf"))
    n = docs.where(F.col(text).isNotNull()).groupBy(*group).agg(F.count_distinct(key).alias("n"))
    df = tf.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("df"))
    raw = tf.join(df, [*group, "term"]).join(n, list(group)).withColumn("raw", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    size = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*group, key)))
    return raw.select(*group, key, "term", (F.col("raw") / size).alias("weight"))


def lexical_score(text: Column, query: Sequence[str]) -> Column:
    """Share of the query's terms that the text holds: the default scorer of rerank()."""
    words = terms_of(text)
    hits = [F.array_contains(words, q.lower()).cast("int") for q in query]
    return sum(hits[1:], hits[0]) / F.lit(float(len(query))) if hits else F.lit(0.0)


def candidates_wanted(n: int, rerank: bool, initial_k: int | None) -> int:
    """How many candidates the first stage fetches for n results."""
    return (initial_k or 3 * n) if rerank else n


def rerank(candidates: DataFrame, score: Column, n: int, key: str) -> DataFrame:
    """The n best candidates by score, ties by key. The candidates are limited before the scorer sees them."""
    return candidates.withColumn("rerank_score", score).orderBy(F.desc("rerank_score"), key).limit(n)


def citation(title: Column, author: Column, source_file: Column) -> Column:
    """`author, "title"`, what there is of it; the file's base name without both; Unknown without anything."""
    named = F.concat_ws(", ", author, F.concat(F.lit('"'), title, F.lit('"')))
    return F.when(named != "", named).otherwise(F.coalesce(F.regexp_extract(source_file, r"([^/\\]+)$", 1), F.lit("Unknown")))


def full_citation(number: Column, date: Column, title: Column, page: Column, source: Column) -> Column:
    """`Sermon #<number>, <date>, "<title>", p. <page>`, what there is of it; without anything the file's base name, or
    Unknown Source. Empty values and the title `Unknown Title` count as none."""
    there = lambda c, before="", after="": F.when((c.cast("string") != "") & (c.cast("string") != "Unknown Title"), F.concat(F.lit(before), c.cast("string"), F.lit(after)))
    named = F.concat_ws(", ", there(number, "Sermon #"), there(date), there(title, '"', '"'), there(page, "p. "))
    file = F.regexp_extract(source, r"([^/]*)$", 1)
    return F.when(named != "", named).when(file != "", file).otherwise(F.lit("Unknown Source"))


def context(ranked: DataFrame) -> DataFrame:
    """One row: `context` of ranked rows (rank, citation, text), in order, and the `guide` of their citations.

    The input is a top-k: what is collected into one value is as small as k.
    """
    rows = F.array_sort(F.collect_list(F.struct("rank", "citation", F.coalesce("text", F.lit("")).alias("text"))))
    source = lambda r: F.concat(F.lit("Source "), r["rank"].cast("string"))
    return ranked.agg(rows.alias("r")).select(
        F.array_join(F.transform("r", lambda r: F.concat(F.lit("["), source(r), F.lit(" - "), r["citation"], F.lit("]:\n"), r["text"])), "\n\n---\n\n").alias("context"),
        F.array_join(F.transform("r", lambda r: F.concat(source(r), F.lit(": "), r["citation"])), "\n").alias("guide"),
    )
