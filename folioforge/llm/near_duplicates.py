"""Near-duplicate records: covering locality-sensitive hashing over a sketch, then exact verification.

Each distinct text gets a sketch of DIMS symbols: the minimum hash of its word shingles under DIMS hash functions; two texts
agree in a symbol with the probability of their Jaccard similarity. The sketch is cut into PARTS of six symbols, and each
part has the three masks of the code {01, 10, 11}: mask v keeps the symbols whose code has an odd product with v, four of
the six. If two sketches differ in one symbol of a part, some mask of that part leaves it out; so every pair within the
radius 2 * PARTS - 1 has a part with at most one difference and agrees in some masked table: no pair within the radius is
missed. Beyond it a pair still collides as soon as two of the three symbol pairs of one part agree.

Exact copies are one class before anything is compared. Candidates meet in a join on the masked key and two blocks of its
bucket, so no bucket's pairs are worked off by one task. Texts in question are picked by a Bloom filter of fixed size before
anything of theirs moves; one bit of each symbol turns unlike candidates away; the rest is verified on the texts' shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import hash_filter, mix64, passes
from folioforge.operators.components import connected_components
from folioforge.session import cut_lineage

WORD = re.compile(r"[^\W_]+")
PARTS = 12
DIMS = 6 * PARTS
RADIUS = 2 * PARTS - 1
TABLES = 3 * PARTS
BLOCK = 512  # texts of a bucket that one key of the join holds
#: Codes of the three symbol pairs of a part, and the masks over them: mask v keeps pair m if the product of v and m is odd.
CODES = (0b01, 0b10, 0b11)
MASKS = tuple(tuple(bin(v & m).count("1") % 2 == 1 for m in CODES for _ in range(2)) for v in CODES)
SEED = 0x9E3779B97F4A7C15
_HASHES = np.random.default_rng(SEED & 0xFFFFFFFF).integers(1, 1 << 63, DIMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Hashes of the distinct runs of `width` words of many texts at once."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        if len(self.known) > 1_000_000:
            self.known.clear()
        h = self.known[word] = xxhash.xxh3_64_intdigest(word.lower().encode())
        return h

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of words of each text, shingles of all texts: sorted and distinct within a text, their offsets)."""
        known, make = self.known, self._hash
        flat: list[int] = []
        sizes = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            found = WORD.findall(t) if t else ()
            sizes[k] = len(found)
            flat += [known[w] if w in known else make(w) for w in found]
        words = np.array(flat, np.uint64)
        n = len(words)
        w = self.width
        owner = np.repeat(np.arange(len(texts)), sizes)
        if n < w:
            return sizes, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        with np.errstate(over="ignore"):
            runs = words[: n - w + 1].copy()
            for j in range(1, w):
                runs = mix64(runs * np.uint64(SEED) + words[j : n - w + 1 + j])
        inside = owner[: n - w + 1] == owner[w - 1 :]
        runs, of = runs[inside], owner[: n - w + 1][inside]
        order = np.lexsort((runs, of))
        runs, of = runs[order], of[order]
        if len(runs):
            keep = np.ones(len(runs), bool)
            keep[1:] = (runs[1:] != runs[:-1]) | (of[1:] != of[:-1])
            runs, of = runs[keep], of[keep]
        return sizes, runs, np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(texts)))))


def sketch(runs: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """DIMS x texts minima; every text has a shingle."""
    out = np.empty((DIMS, len(offsets) - 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(DIMS):
            out[j] = np.minimum.reduceat(runs * _HASHES[j], offsets[:-1])
    return out


def masked_keys(symbols: np.ndarray) -> np.ndarray:
    """TABLES x texts keys: a hash of the table's number and the symbols its mask keeps."""
    out = np.empty((TABLES, symbols.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for p in range(PARTS):
            for m, mask in enumerate(MASKS):
                key = np.full(symbols.shape[1], p * len(MASKS) + m + 1, np.uint64)
                for j in np.flatnonzero(mask):
                    key = mix64(key * np.uint64(SEED) + symbols[6 * p + j])
                out[p * len(MASKS) + m] = key
    return out


def _signatures(base: DataFrame, width: int, least_words: int) -> DataFrame:
    """(table_key, h) of every distinct text h, TABLES rows each; a task gives a text it meets again only once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen = Shingler(width), set()
        for batch in batches:
            hashes, fresh = batch.column(0).to_pylist(), []
            for k, h in enumerate(hashes):
                if h not in seen:
                    seen.add(h)
                    fresh.append(k)
            if len(seen) > 2_000_000:
                seen.clear()
            texts = batch.column(1).take(pa.array(fresh, pa.int64())).to_pylist()
            sizes, runs, offsets = shingle(texts)
            counts = np.diff(offsets)
            kept = np.flatnonzero((sizes >= least_words) & (counts > 0))
            if len(kept):
                chosen = np.zeros(len(texts), bool)
                chosen[kept] = True
                runs = runs[np.repeat(chosen, counts)]
                symbols = sketch(runs, np.concatenate(([0], np.cumsum(counts[kept]))))
                keys = (masked_keys(symbols) << np.uint64(24)).view(np.int64)  # 40 bits: candidates are verified, and zeros cost nothing in the shuffle
                owner = np.array([hashes[fresh[k]] for k in kept], np.int64)
                # the keys of a text stand together, so that its hash compresses in the shuffle
                yield pa.RecordBatch.from_arrays([pa.array(keys.T.ravel()), pa.array(np.repeat(owner, TABLES))], names=["table_key", "h"])

    return base.select("h", "text").mapInArrow(run, "table_key bigint, h bigint")


def _texts_of(found: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the rows of found (id, text) whose id is among ids (id), and of few others, without a shuffle."""
    held = found.sparkSession.sparkContext.broadcast(hash_filter(ids.select(F.xxhash64("id").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(batch.column(2), held.value))).select([0, 1])

    kind = found.schema["id"].dataType.simpleString()
    return found.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(run, f"id {kind}, text string")


def _in_question(base: DataFrame, wanted: DataFrame, width: int, least_words: int) -> DataFrame:
    """(id, h, h2, n, bits, text) of the rows of base whose text is wanted, and of few others, without a shuffle.

    n: distinct shingles; bits: one bit of each of the first 64 sketch symbols; texts of too few words are left out.
    """
    held = base.sparkSession.sparkContext.broadcast(hash_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, known = Shingler(width), held.value
        for batch in batches:
            batch = batch.filter(pa.array(passes(batch.column(1), known)))
            sizes, runs, offsets = shingle(batch.column(3).to_pylist())
            counts = np.diff(offsets)
            bits = np.zeros(len(counts), np.uint64)
            some = np.flatnonzero(counts)
            if len(some):
                symbols = mix64(sketch(runs, np.concatenate(([0], np.cumsum(counts[some]))))[:64])
                bits[some] = ((symbols & np.uint64(1)) << np.arange(64, dtype=np.uint64)[:, None]).sum(axis=0, dtype=np.uint64)
            columns = [*batch.columns[:3], pa.array(counts.astype(np.int32)), pa.array(bits.view(np.int64)), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "h2", "n", "bits", "text"]).filter(pa.array((sizes >= least_words) & (counts > 0)))

    kind = base.schema["id"].dataType.simpleString()
    seen = base.select("id", "h", F.xxhash64(F.lit(7), F.reverse("text")).alias("h2"), "text")
    return seen.mapInArrow(run, f"id {kind}, h bigint, h2 bigint, n int, bits bigint, text string")


def _verified(met: DataFrame, width: int, threshold: float) -> DataFrame:
    """(a, b, similarity) of the rows of met (a, b, text_a, text_b) whose similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                n = part.num_rows
                sides = [part.column(k).dictionary_encode() for k in (2, 3)]  # a text is cut up once for all its pairs
                (_, ra, oa), (_, rb, ob) = (shingle(s.dictionary.to_pylist()) for s in sides)
                ia, ib = (s.indices.to_numpy() for s in sides)
                common = np.fromiter((len(np.intersect1d(ra[oa[i] : oa[i + 1]], rb[ob[j] : ob[j + 1]], assume_unique=True)) for i, j in zip(ia, ib)), np.int64, n)
                either = np.diff(oa)[ia] + np.diff(ob)[ib] - common
                same = pa.array(common >= threshold * either - 1e-9)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(common / either)], names=["a", "b", "similarity"]).filter(same)

    kind = met.schema["a"].dataType.simpleString()
    return met.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}, similarity double")


def least_bits(threshold: float) -> int:
    """Agreeing bits of 64 that a pair at the threshold has with all but some 3 in a million, mean less 4.5 deviations: so few
    links at the threshold are lost, and fewer above it."""
    p = (1 + threshold) / 2
    return int(np.floor(64 * p - 4.5 * np.sqrt(64 * p * (1 - p))))


def _bucket_pairs(signed: DataFrame) -> DataFrame:
    """(ha, hb), ha < hb: distinct pairs of texts that share a bucket.

    Texts alone in a bucket, nearly all, go after one shuffle. A bucket is cut into blocks of some BLOCK texts, and every
    two of its blocks meet under a key of their own, so a hot bucket is spread over many tasks.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy("table_key"))
    several = signed.repartition("table_key").dropDuplicates(["table_key", "h"]).withColumn("n", size).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = several.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    placed = cut_lineage(placed.select("table_key", "h", "block", "blocks"))  # both sides of the join read it
    x = placed.select("table_key", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), F.col("h").alias("hx"))
    y = placed.select("table_key", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"), F.col("h").alias("hy"))
    met = x.join(y, ["table_key", "i", "j"]).where("i < j or hx < hy")
    return met.select(F.least("hx", "hy").alias("ha"), F.greatest("hx", "hy").alias("hb")).distinct()


def _base(records: DataFrame, key: str, text: str) -> DataFrame:
    t = F.col(text).cast("string")
    named = records.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    return named.select(F.col(key).alias("id"), t.alias("text"), F.xxhash64(t).alias("h"))


def similar_classes(records: DataFrame, *, key: str, text: str, threshold: float, width: int, least_words: int) -> tuple[DataFrame, DataFrame]:
    """(links, members).

    members (class_id, id): every record with a text of at least least_words words that is in a link or shares its text
    with another record; class_id is the least id of the same text. links (a, b, similarity), a < b: classes of different
    texts whose Jaccard similarity of distinct runs of `width` words is at least the threshold.
    """
    base = _base(records, key, text)
    signed = _signatures(base, width, least_words)
    pairs = cut_lineage(_bucket_pairs(signed))
    copied = base.select("h", "id").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    wanted = cut_lineage(pairs.select(F.col("ha").alias("h")).union(pairs.select("hb")).union(copied).distinct())
    # equal hashes of different texts are told apart by the second hash
    found = cut_lineage(_in_question(base, wanted, width, least_words))
    classes = cut_lineage(found.groupBy("h", "h2").agg(F.min("id").alias("class_id"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    # a common phrase can bring many unlike texts into one bucket: sizes and bits, 24 bytes a text, turn those away
    small = lambda s: classes.select(F.col("h").alias(f"h{s}"), F.col("class_id").alias(f"c{s}"), F.col("bits").alias(f"b{s}"), F.col("n").alias(f"n{s}"))
    like = pairs.join(small("a"), "ha").join(small("b"), "hb")
    like = like.where((F.col("na") >= F.col("nb") * threshold - 1e-9) & (F.col("nb") >= F.col("na") * threshold - 1e-9))
    like = like.where(F.bit_count(F.col("ba").bitwiseXOR(F.col("bb"))) <= 64 - least_bits(threshold))
    like = like.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
    # the text of a class moves to its pairs: text compresses, hashes of its shingles would not
    like = cut_lineage(like.where("a < b").distinct())
    texts = _texts_of(found.select("id", "text"), like.select(F.explode(F.array("a", "b")).alias("id")))
    side = lambda s: texts.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))
    links = _verified(like.join(side("a"), "a").join(side("b"), "b"), width, threshold)
    links = cut_lineage(links.distinct())  # a record loaded again gives its text twice
    members = found.select("h", "h2", "id").distinct().join(classes.select("h", "h2", "class_id"), ["h", "h2"]).select("class_id", "id")
    return links, members


def near_duplicate_pairs(records: DataFrame, *, key: str, text: str, threshold: float = 0.8, width: int = 5, least_words: int = 20, expand: int = 1000) -> DataFrame:
    """(id_a, id_b) with id_a < id_b: records whose texts have at least least_words words and a Jaccard similarity of at
    least the threshold over their distinct runs of `width` words. Words are the longest runs of letters and digits, in
    lower case.

    Records of one key are one record; null keys and null, empty or short texts are in no pair. Copies of one text are
    expanded into all pairs up to `expand` copies. A larger class, whose pairs would grow with its square, is given
    exactly by its least record: that one is paired with every copy and stands for the class in pairs with other texts.
    An empty table gives no rows; extra columns are ignored.
    """
    links, members = similar_classes(records, key=key, text=text, threshold=threshold, width=width, least_words=least_words)
    members = cut_lineage(members)
    size = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    spread = members.join(size, "class_id").where((F.col("n") <= expand) | (F.col("class_id") == F.col("id"))).select("class_id", "id")
    one = lambda c, s: spread.select(F.col("class_id").alias(c), F.col("id").alias(s))
    across = links.join(one("a", "x"), "a").join(one("b", "y"), "b").select("x", "y")
    within = one("class_id", "x").join(one("class_id", "y"), "class_id").where("x < y").select("x", "y")
    star = members.join(size.where(F.col("n") > expand), "class_id").where("id <> class_id").select(F.col("class_id").alias("x"), F.col("id").alias("y"))
    return across.union(within).union(star).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def near_duplicate_groups(records: DataFrame, *, key: str, text: str, threshold: float = 0.8, width: int = 5, least_words: int = 20) -> DataFrame:
    """(id, class_id, group_id, n_links) of every record that has a near duplicate or a copy.

    class_id: least id with the same text; group_id: least class of the connected component of links; n_links: links of
    its class to classes of other texts.
    """
    links, members = similar_classes(records, key=key, text=text, threshold=threshold, width=width, least_words=least_words)
    groups = connected_components(links, "a", "b")
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    out = members.join(groups.select(F.col("node").alias("class_id"), F.col("component").alias("group_id")), "class_id", "left").join(degree, "class_id", "left")
    out = out.select("id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    several = out.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_id")
    return out.join(several, "group_id", "left_semi").select("id", "class_id", "group_id", "n_links")
