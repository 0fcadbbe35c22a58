"""Cutting documents into parents, sentences and chunks."""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import STOP_WORDS, contained_terms, is_heading_line, sentences, tidy_layout, verse_references, whole_terms, word_count


def window_spans(length: int, stops: Sequence[int], size: int, overlap: int, tail: bool = False, kept: int = 1) -> list[tuple[int, int]]:
    """[start, end) of windows of at most size characters over a text, each ending at the last stop inside it, but for
    its first character, if there is one; the next starts overlap characters before the end, but always further on. stops:
    ascending positions of the stops, of which the first `kept` characters belong to the window.
    tail: where the last window has fewer than overlap characters to spare, what it would share with a next one follows
    as a window of its own."""
    from bisect import bisect_left

    out, start = [], 0
    while start < length:
        end = min(start + size, length)
        if end < length:
            k = bisect_left(stops, end)
            if k and stops[k - 1] > start:
                end = stops[k - 1] + kept
        out.append((start, end))
        if end < length:
            start = max(end - overlap, start + 1)
        elif tail and size > overlap:
            start += size - overlap
        else:
            break
    return out


_SENTENCE_STOP, _SPACE_STOP = re.compile(r"[.!?]"), re.compile(r" ")


def fixed_windows(docs: DataFrame, *, key: str, text: str, size: int = 1500, overlap: int = 200, at: str = "sentence", tail: bool = False) -> DataFrame:
    """(key, chunk_no, start, text): windows that end after the last sentence mark (at="sentence") or before the last space (at="space").

    start counts from 0; tail as for window_spans. A text no longer than size is one window; null and blank texts have none; blank windows are dropped.
    """
    stop, kept = (_SENTENCE_STOP, 1) if at == "sentence" else (_SPACE_STOP, 0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, t in zip(frame["k"], frame["t"]):
                spans = window_spans(len(t), [m.start() for m in stop.finditer(t)], size, overlap, tail, kept)
                rows += [(k, n, a, t[a:b].strip()) for n, (a, b) in enumerate(((a, b) for a, b in spans if t[a:b].strip()), 1)]
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "start", "text"])

    kind = docs.schema[key].dataType.simpleString()
    ready = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    return ready.mapInPandas(run, f"`{key}` {kind}, chunk_no int, start int, text string")


def sentence_rows(docs: DataFrame, *, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, sent_no, sentence), numbered from 1."""
    rows = docs.select(*keys, F.posexplode(sentences(F.col(text))).alias("n", "sentence"))
    return rows.select(*keys, (F.col("n") + 1).alias("sent_no"), "sentence")


def _pieces_before_headings(text: Column) -> Column:
    """The text cut before every heading line but the first line: each line is looked at once, each piece joined once."""

    def cut(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i == 1) | is_heading_line(lines[i - 1]))
        piece = lambda at: F.transform(at, lambda x, k: F.array_join(F.slice(lines, x, F.coalesce(F.get(at, k + 1), F.size(lines) + 1) - x), "\n"))
        return F.transform(F.array(starts), piece)[0]

    return F.transform(F.array(F.split(text, "\n")), cut)[0]


def recursive_split(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Pieces of at most size characters, cut before the first separator that occurs (the empty one is between any two
    characters), the longer ones by the separators behind it; pieces are filled up to size and start with up to overlap
    characters of the one before, in whole parts. A part without a separator left stays, whatever its length."""
    if len(text) <= size:
        return [text.strip()] if text.strip() else []
    at = next((k for k, s in enumerate(separators) if not s or s in text), None)
    if at is None:
        return [text.strip()]
    sep, rest = separators[at], separators[at + 1 :]
    first, *others = text.split(sep) if sep else text
    parts = [p for p in (first, *(sep + x for x in others)) if p]
    out: list[str] = []
    held: deque[str] = deque()
    n = 0
    for part in parts:
        if len(part) >= size and rest:
            if held:
                out.append("".join(held))
                held.clear()
                n = 0
            out += recursive_split(part, size, overlap, rest)
            continue
        if held and n + len(part) > size:
            out.append("".join(held))
            while held and (n > overlap or n + len(part) > size):
                n -= len(held.popleft())
        held.append(part)
        n += len(part)
    if held:
        out.append("".join(held))
    return [p for p in (x.strip() for x in out) if p]


def split_recursively(docs: DataFrame, *, key: str, text: str, size: int = 1000, overlap: int = 200, separators: Sequence[str] = ("\n\n", "\n", ".", "!", "?", ",", " ", "")) -> DataFrame:
    """(key, chunk_no, text) by recursive_split; null and blank texts have no chunks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, n, p) for k, t in zip(frame["k"], frame["t"]) for n, p in enumerate(recursive_split(t, size, overlap, separators), 1)]
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "text"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"`{key}` {kind}, chunk_no int, text string")


#: Where parents over their size are cut, strongest first.
PARENT_SEPARATORS = ("\n\n\n", "\n\n", "\n", " ", "")


def parent_chunks(docs: DataFrame, *, key: str, text: str, size: int = 30_000, overlap: int = 200, least: int = 3) -> DataFrame:
    """(key, parent_no, text): a document is cut before heading lines; where that gives fewer than `least` parts, at
    blank lines of three or more line breaks; then every part over size is cut recursively. Blank parts are dropped."""
    trim = lambda parts: F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("t")).withColumn("a", trim(_pieces_before_headings(F.col("t")))).withColumn("b", trim(F.split("t", r"\n{3,}")))
    parts = rows.select(key, F.posexplode(F.when(F.size("a") >= least, F.col("a")).when(F.size("b") >= least, F.col("b")).otherwise(trim(F.array("t")))).alias("p", "t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, p, n, x) for k, p, t in zip(frame["k"], frame["p"], frame["t"]) for n, x in enumerate(recursive_split(t, size, overlap, PARENT_SEPARATORS))]
            yield pd.DataFrame(out, columns=[key, "p", "n", "text"])

    from pyspark.sql import Window

    kind = docs.schema[key].dataType.simpleString()
    cut = parts.select(F.col(key).alias("k"), "p", "t").mapInPandas(run, f"`{key}` {kind}, p int, n int, text string")
    return cut.select(key, F.row_number().over(Window.partitionBy(key).orderBy("p", "n")).alias("parent_no"), "text")


_TERM = re.compile(r"\b\w\w+\b")


def fold_sentences(rows: Sequence[str], items: Sequence[Sequence[str]], threshold: float, most: int, stop: frozenset[str], features: int = 100) -> list[list[int]]:
    """Positions of the sentences of each chunk. A sentence joins the open chunk if it shares an item with it or its
    cosine with the chunk's mean term vector is over the threshold, and the chunk stays within `most` words."""
    terms = [[t for t in _TERM.findall(s.lower()) if t not in stop] for s in rows]
    total = Counter(t for x in terms for t in x)
    top = {t for t, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:features]}
    df = Counter(t for x in terms for t in set(x) & top)
    vectors = []
    for x in terms:
        v = {t: n * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in Counter(x).items() if t in top}
        size = math.sqrt(sum(y * y for y in v.values()))
        vectors.append({t: y / size for t, y in v.items()} if size else {})
    out: list[list[int]] = []
    sums: Counter[str] = Counter()
    held: set[str] = set()
    words = 0
    for k, s in enumerate(rows):
        n = len(s.split())
        if out:
            size = math.sqrt(sum(y * y for y in sums.values()))
            close = sum(y * sums[t] for t, y in vectors[k].items()) / size if size and vectors[k] else 0.0
            if (held & set(items[k]) or close > threshold) and words + n <= most:
                out[-1].append(k)
                sums.update(vectors[k])
                held |= set(items[k])
                words += n
                continue
        out.append([k])
        sums, held, words = Counter(vectors[k]), set(items[k]), n
    return out


def hybrid_chunks(sents: DataFrame, *, group: Sequence[str], terms: Sequence[str], most_words: int = 1000, dense: float = 1.0, thresholds: tuple[float, float] = (0.25, 0.35), stop: Sequence[str] = ()) -> DataFrame:
    """(group, child_no, text, n_sentences, items) from sentences (group, sent_no, sentence) by fold_sentences.

    items: terms contained in a sentence, in any letter case. The threshold is the higher one where a group has more than
    `dense` items a sentence. A group is one parent, whose size the parent operator bounds.
    """
    group, low, words = list(group), [t.lower() for t in terms], frozenset(stop)

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("sent_no")
        rows = frame["sentence"].tolist()
        items = [[t for t in low if t in s.lower()] for s in rows]
        density = sum(map(len, items)) / len(rows)
        chunks = fold_sentences(rows, items, thresholds[1] if density > dense else thresholds[0], most_words, words)
        head = [frame[g].iloc[0] for g in group]
        return pd.DataFrame([(*head, n, " ".join(rows[k] for k in c), len(c), sorted({t for k in c for t in items[k]})) for n, c in enumerate(chunks, 1)], columns=[*group, "child_no", "text", "n_sentences", "items"])

    kinds = ", ".join(f"`{g}` {sents.schema[g].dataType.simpleString()}" for g in group)
    return sents.groupBy(*group).applyInPandas(fold, f"{kinds}, child_no int, text string, n_sentences int, items array<string>")


def chunk_documents(docs: DataFrame, *, key: str, text: str, keywords: Sequence[str], figures: Sequence[str], size: int = 30_000, most_words: int = 1000, least_chars: int = 100) -> DataFrame:
    """(key, parent_id, child_id, unique_id, text, n_words, keywords, figures, verses): parents, sentences and children of
    every document of at least least_chars characters after cleaning, with the marks of each child.

    unique_id is `file<key>_<parent_id>_<child_id>`. Null, blank and short texts have no chunks.
    """
    clean = docs.select(F.col(key), tidy_layout(F.col(text)).alias("t")).where(F.char_length("t") >= least_chars)
    parents = parent_chunks(clean, key=key, text="t", size=size)
    children = hybrid_chunks(sentence_rows(parents, keys=[key, "parent_no"], text="text"), group=[key, "parent_no"], terms=keywords, most_words=most_words, stop=STOP_WORDS)
    parent, child = F.concat(F.lit("parent_"), "parent_no"), F.concat(F.lit("child_"), "child_no")
    return children.select(
        key, parent.alias("parent_id"), child.alias("child_id"), F.concat(F.lit("file"), F.col(key).cast("string"), F.lit("_"), parent, F.lit("_"), child).alias("unique_id"), "text",
        word_count(F.col("text")).alias("n_words"), contained_terms(F.col("text"), keywords).alias("keywords"), whole_terms(F.col("text"), figures).alias("figures"), verse_references(F.col("text")).alias("verses"),
    )
