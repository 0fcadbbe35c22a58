"""Encoding of a corpus with a public byte-level BPE vocabulary, in Spark's own expressions.

The rank of every token stands in the plan as one literal: an array of small maps, addressed by a hash, so a lookup reads
a handful of entries. A word (a pre-token of the published pattern) is folded from its single bytes: each step merges the
leftmost adjacent pair of the lowest rank and looks up the two pairs that this creates. Words repeat, so the most frequent
`dictionary_words` words of the corpus, counted over all documents, are folded once each and their ids become a second
literal of bounded size; any other word is folded where it stands. Both ways give the same ids; no word is left out. The
encoding itself is a narrow projection: no join, no shuffle of texts, no Python on the executors.

Bytes are written as characters U+0000 to U+00FF (ISO-8859-1), since JSON and map keys hold strings.
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the published pre-tokenisation pattern of the vocabulary; (?U) makes Java's \s the Unicode White_Space class.
WORD_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

RANK_BUCKETS = 16384
WORD_BUCKETS = 8192
STRETCH, WINDOW = 96, 48  # bytes of a long word that are folded at once, and those around a cut


@lru_cache(maxsize=4)
def load_ranks(path: str = DEFAULT_VOCABULARY) -> dict[str, int]:
    """Token (bytes as ISO-8859-1 characters) -> id, from a tiktoken rank file."""
    ranks = {}
    with open(os.path.realpath(path), "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token).decode("latin-1")] = int(rank)
    return ranks


def _hash(text: str, buckets: int) -> int:
    """CRC-32 of the UTF-8 bytes, which Spark has as a built-in."""
    import zlib

    return zlib.crc32(text.encode()) % buckets


def _map_literal(entries: dict[str, object], buckets: int, value_type: str) -> Column:
    """An array of maps as a constant: the optimizer folds the parse once, on the driver."""
    parts: list[dict[str, object]] = [{} for _ in range(buckets)]
    for k, v in entries.items():
        parts[_hash(k, buckets)][k] = v
    return F.from_json(F.lit(json.dumps(parts)), f"array<map<string,{value_type}>>")


def _lookup(literal: Column, buckets: int, key: Column) -> Column:
    return literal[(F.crc32(key.cast("binary")) % F.lit(buckets)).cast("int")][key]


def _let(value: Column, body) -> Column:
    """body(value) with value computed once; a large constant then stands once in the plan."""
    return F.transform(F.array(value), body)[0]


def _fold(raw: Column, rank) -> Column:
    """The tokens, as byte strings, of a byte string that is not empty, by ranked merges."""
    size = F.char_length(raw)
    parts = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(raw, i, F.lit(1)))
    none = F.array().cast("array<int>")

    def pair_ranks(p: Column) -> Column:
        return F.when(F.size(p) > 1, F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: rank(F.concat(p[i - 1], p[i])))).otherwise(none)

    def step(state: Column, _: Column) -> Column:
        p, r = state["p"], state["r"]

        def merge(at: Column) -> Column:
            pair = F.concat(p[at - 1], p[at])
            n = F.size(p)

            def rebuilt(x: Column) -> Column:
                left = F.when(at > 1, F.array(rank(F.concat(p[at - 2], x)))).otherwise(none)
                right = F.when(at + 1 < n, F.array(rank(F.concat(x, p[at + 1])))).otherwise(none)
                return F.struct(
                    F.concat(F.slice(p, F.lit(1), at - 1), F.array(x), F.slice(p, at + 2, n)).alias("p"),
                    F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(r, at + 2, n)).alias("r"),
                )

            return _let(pair, rebuilt)

        return _let(F.array_min(r), lambda m: F.when(m.isNull(), state).otherwise(_let(F.array_position(r, m).cast("int"), merge)))

    start = _let(parts, lambda p: F.struct(p.alias("p"), pair_ranks(p).alias("r")))
    steps = F.when(size > 1, F.sequence(F.lit(2), size)).otherwise(none)
    return F.aggregate(steps, start, step, lambda s: s["p"])


def _fold_long(raw: Column, rank) -> Column:
    """The tokens of a byte string of more than STRETCH bytes, in stretches.

    A cut is placed where the tokens of the WINDOW around it end. Tokens are those of the whole string if every two that
    stand side by side stay apart when they are folded alone; inside a stretch they do, so only the two at each cut are
    asked. A string of which a cut fails this is folded as a whole.
    """
    size = F.char_length(raw)
    half = WINDOW // 2

    def cut(k: Column) -> Column:
        begin = k * STRETCH - half  # bytes before the window
        tokens = _fold(F.substring(raw, begin + 1, F.lit(WINDOW)), rank)
        reach = F.aggregate(tokens, F.lit(0), lambda n, t: F.when(n >= half, n).otherwise(n + F.char_length(t)))
        return F.least(begin + reach, size)

    cuts = F.array_distinct(F.concat(F.array(F.lit(0)), F.transform(F.sequence(F.lit(1), ((size - 1) / STRETCH).cast("int")), cut), F.array(size)))
    stretches = _let(cuts, lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda k: F.substring(raw, c[k - 1] + 1, c[k] - c[k - 1])))

    def joined(folded: Column) -> Column:
        def apart(k: Column) -> Column:
            left, right = F.element_at(folded[k - 1], -1), folded[k][0]
            return _let(_fold(F.concat(left, right), rank), lambda t: (F.size(t) == 2) & (t[0] == left))

        whole = F.when(F.size(folded) > 1, F.forall(F.sequence(F.lit(1), F.size(folded) - 1), apart)).otherwise(F.lit(True))
        return F.when(whole, F.flatten(folded)).otherwise(_fold(raw, rank))

    return _let(F.transform(stretches, lambda x: _fold(x, rank)), joined)


def fold_word(word: Column, ranks: Column) -> Column:
    """Ids of one word (null for null) by ranked merges over its bytes."""
    rank = lambda x: _lookup(ranks, RANK_BUCKETS, x)

    def ids(raw: Column) -> Column:
        size = F.char_length(raw)
        tokens = F.when(size > 2 * STRETCH, _fold_long(raw, rank)).when(size > 0, _fold(raw, rank)).when(size == 0, F.array().cast("array<string>"))
        return F.transform(tokens, rank)

    return _let(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ids)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def frequent_words(docs: DataFrame, text: str, limit: int) -> DataFrame:
    """The `limit` most frequent words over all documents (ties by the word)."""
    counted = docs.select(F.explode(words_of(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "word").limit(limit).select("word")


def word_ids(docs: DataFrame, text: str, limit: int, ranks: Column) -> dict[str, list[int]]:
    """Ids of the frequent words; at most `limit` rows reach the driver."""
    words = frequent_words(docs, text, limit)
    slots = max(8, docs.sparkSession.sparkContext.defaultParallelism)
    return {r.word: list(r.ids) for r in words.repartition(slots).select("word", _let(ranks, lambda r: fold_word(F.col("word"), r)).alias("ids")).collect()}


def encode(docs: DataFrame, *, text: str = "text", out: str = "ids", vocabulary: str = DEFAULT_VOCABULARY, dictionary_words: int = 20_000) -> DataFrame:
    """docs with the column `out`: array<int> of the ids of `text`, without special tokens.

    Empty and null texts both give an empty array. Strings that look like special tokens are ordinary text. Every row of
    docs is kept, repeated ones too; other columns pass through, one named `out` is replaced. dictionary_words bounds what
    is collected and put in the plan (some 30 bytes each); it has no effect on the result.
    """
    ranks = _map_literal(load_ranks(vocabulary), RANK_BUCKETS, "int")
    known = word_ids(docs, text, dictionary_words, ranks)
    table = _map_literal(known, WORD_BUCKETS, "array<int>")
    words = words_of(F.col(text))
    ids = _let(table, lambda t: _let(ranks, lambda r: F.flatten(F.transform(words, lambda w: F.coalesce(_lookup(t, WORD_BUCKETS, w), fold_word(w, r))))))
    return docs.withColumn(out, F.coalesce(ids, F.array().cast("array<int>")))


def decode(rows: DataFrame, *, ids: str = "ids", out: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """rows with the column `out`: the text of `ids`. Null gives null, an empty array an empty text.

    An id outside the vocabulary contributes nothing. Concatenates the byte strings of the tokens.
    """
    tokens: dict[int, str] = {v: k for k, v in load_ranks(vocabulary).items()}
    listed = F.from_json(F.lit(json.dumps([tokens.get(k) for k in range(max(tokens) + 1)])), "array<string>")
    pieces = F.transform(F.col(ids), lambda i: F.coalesce(F.get(listed, i), F.lit("")))
    return rows.withColumn(out, F.decode(F.encode(F.array_join(pieces, ""), "ISO-8859-1"), "UTF-8"))
