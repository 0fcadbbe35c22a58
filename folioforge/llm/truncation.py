"""Texts cut off by field limits or broken transfers: end-of-text against continuation under a backward character n-gram model.

A context is the run of characters read backwards from a position. The model counts, over all documents, how often a
sentence or text ended after a context and how often it went on. Contexts are read in three ways:

* the last word back to its start, by itself, in its language, and with the 4 characters before it: does the word end here
  or go on with a letter;
* the last 3, 5, 8 and 12 characters as they stand;
* the last word with 2, 6, 12 and 22 characters of the shape of the text before it; in the shape a word of more than three
  letters is one character (by its case) and so is a number: contexts long enough to reach over a signature or clause,
  which recur although content words differ.

Counts stand in tables of fixed size that are addressed by a hash of the context, each in two rows of which the lesser
counts, so the model has the same size for any corpus; a cell says only what exceeds the median of its table, which is
what unrelated contexts leave in it. The orders are blended from short to long. The log-odds of continuation are judged against a threshold for each
source, language and kind of end, which is fitted on the corpus by expectation maximisation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import hash_filter, mix64, passes
from folioforge.session import cut_lineage

#: What a cut can leave behind its last word.
REMNANT = re.compile(r"(?:\s|…|\.{2,}|\[…\]|\[\.\.\.\]|�|<[^<>\s]{0,12}$|&#?\w{0,8}$|​|﻿)+\Z")
BROKEN = re.compile(r"(?:�|<[^<>]{0,12}|&#?\w{0,8})\s*\Z")
CLOSERS = "\"'”’»›)]}"
BOUNDARY = re.compile(rf"[.!?…][{re.escape(CLOSERS)}]*[^\w\s.,;:!?…]*(?:\s*[☀-➿🀀-🫿️‍])*(?=[ \t]*\n|\s+(?![a-zà-ÿ0-9])|\s*\Z)|\n[ \t]*\n\s*")
OPEN = ("bare", "ellipsis", "broken")

RAW = (3, 5, 8, 12)  # characters as they stand
SHAPE = (2, 6, 12, 22)  # characters of the shape before the last word
WORD = 24  # characters of the last word
KEPT = 3  # letters of a word that stands as it is in the shape
BEFORE = (4,)  # characters before the last word, where no more than KEPT letters of it are there
FIRST = 2 + len(BEFORE)  # tables of words: in any language, in their own, behind the characters before them
TABLES = FIRST + len(RAW) + len(SHAPE)
CELLS = 1 << 18
ROWS = 2
LANGUAGES = 1 << 12
SPAN = ROWS * CELLS * 2  # slots of a table: two rows of cells of (end, on)
SLOTS = TABLES * SPAN + LANGUAGES * 2
PART = 1 << 16  # slots that move as one value
#: Weight of the shorter context in the blend, and what the noise of a table adds to it.
WEIGHT, NOISE = 6.0, 0.3
END, ON, SKIP = 0, 1, 2
SHRINK = 20.0  # ends that the rate of a source weighs in that of one of its languages
PAD = 64  # before each text
PIECE, OVERLAP = 1 << 17, 2048  # characters that are worked off at once, and those of a long text that are read again before the next
FLUSH = 1 << 20  # contexts of a table that wait to be counted
TAIL = 2048  # characters from the end in which the final context lies


def without_remnant(text: str) -> str:
    """The text without white space and remnants at its end; looks at the end only, so long texts cost no more."""
    while True:
        text = text.rstrip()
        m = REMNANT.search(text, max(0, len(text) - 80))
        if m is None:
            return text
        text = text[: m.start()]


def segments(text: str) -> list[tuple[str, bool]]:
    """Sentences and unfinished lines in order, each with whether a mark ends it."""
    out, at = [], 0
    for m in BOUNDARY.finditer(text):
        body = text[at : m.start()]
        marked = text[m.start()] in ".!?…"
        if body.strip():
            out.append((body, marked))
        at = m.end()
    if text[at:].strip():
        out.append((text[at:], False))
    return out


def tail(text: str | None) -> tuple[str, str]:
    """(kind, last sentence or line) of a text, looking at its last TAIL characters.

    empty: nothing there; closed: a mark ends it; broken: a remnant that only a cut leaves; ellipsis: dots in place of a
    mark, which a writer or a cut can leave; bare: anything else.
    """
    if text is None or not text.strip():
        return "empty", ""
    stripped = text.rstrip()
    body = without_remnant(text)
    if not body:
        return "ellipsis", ""
    last, marked = segments(body[-TAIL:])[-1]
    if BROKEN.search(stripped, max(0, len(stripped) - 80)) is not None:
        return ("closed" if marked else "broken"), last
    if marked:
        return "closed", last
    return ("bare" if body == stripped else "ellipsis"), last


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(p)


class Contexts:
    """Cells of the contexts of many texts at once: hashes of windows come from running sums, so a window of any length costs the same."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        n = 2 * PIECE + 2 * OVERLAP + 2 * PAD
        self.up, self.down = _powers(self.BASE, n), _powers(pow(self.BASE, -1, 1 << 64), n)
        self.kind = np.full(0x110000, 255, np.uint8)  # 0 other, 1 small letter, 2 capital, 3 digit; filled as characters come up

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        out = self.kind[codes]
        if (new := out == 255).any():
            for c in np.unique(codes[new]):
                ch = chr(c)
                self.kind[c] = (2 if ch.isupper() else 1) if ch.isalpha() else 3 if ch.isdigit() else 0
            out = self.kind[codes]
        return out

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(1)) * self.up[: len(codes)], dtype=np.uint64)))

    def _cells(self, h: np.ndarray, table: int) -> np.ndarray:
        """ROWS x contexts: slots, without the event, of hashed contexts."""
        with np.errstate(over="ignore"):
            h = mix64(h + np.uint64(table + 1))
        first, second = h & np.uint64(CELLS - 1), (h >> np.uint64(32)) & np.uint64(CELLS - 1)
        return (np.stack([first, second + np.uint64(CELLS)]).astype(np.int64) << 1) + table * SPAN

    def _window(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (sums[hi] - sums[lo]) * self.down[lo]

    def __call__(self, codes: np.ndarray, counted: np.ndarray, slots: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, list[np.ndarray]]:
        """((letters, cells of their word) for each table of words, whether a letter follows, ends of words and marks, their cells in each other table).

        codes: characters, every text behind PAD zeros; counted: the positions that an end may follow; slots: of the
        language of each.
        """
        n = len(codes)
        kind = self.kinds(codes)
        at = np.arange(n)
        letter, digit = (kind == 1) | (kind == 2), kind == 3
        more = np.zeros(n, bool)  # a letter follows
        more[:-1] = letter[1:]
        more &= letter
        start = np.maximum.accumulate(np.where(letter, 0, at + 1))
        start = np.where(letter, start, at)
        sums = self._sums(codes)
        letters = np.flatnonzero(letter & counted)
        word = self._window(sums, np.maximum(start[letters], letters + 1 - WORD), letters + 1)
        words = [(letters, self._cells(word, 0))]
        with np.errstate(over="ignore"):
            words.append((letters, self._cells(word + mix64(slots[letters].astype(np.uint64)), 1)))
        begun = letters[letters - start[letters] < KEPT]
        words += [(begun, self._cells(self._window(sums, np.maximum(start[begun] - k, 0), begun + 1), 2 + j)) for j, k in enumerate(BEFORE)]
        number = np.zeros(n, bool)  # a digit follows a digit
        number[:-1] = digit[1:] & digit[:-1]
        ends = np.flatnonzero(counted & ~more & ~number & (codes != 32) & ((codes < 9) | (codes > 13)))
        tables = [self._cells(self._window(sums, np.maximum(ends + 1 - k, 0), ends + 1), FIRST + j) for j, k in enumerate(RAW)]
        # the shape: long words by one character for their case, numbers by one
        last = np.flatnonzero(letter & ~more)
        long = last[last + 1 - start[last] > KEPT]
        inside = np.zeros(n + 1, np.int8)
        inside[start[long]] += 1
        inside[long + 1] -= 1
        within = np.cumsum(inside[:n], dtype=np.int8) > 0
        shape = codes.copy()
        small = letter & ~within & (kind == 2)
        shape[small] = codes[small] | 32  # a short word stands in small letters
        first = start[long]
        shape[first] = np.where(kind[first] == 2, np.where(kind[first + 1] == 2, 0x110001, 0x110002), 0x110003)
        shape[digit] = 0x110004
        stays = ~(within & (at != start)) & ~np.concatenate(([False], number[:-1]))
        before = np.cumsum(stays)[start[ends]] - 1
        short = letter[ends] & (ends - start[ends] < KEPT)
        own = np.where(short, self._window(sums, start[ends], ends + 1), mix64(shape[start[ends]].astype(np.uint64)))  # the last word, mark or number
        sums = self._sums(shape[stays])
        with np.errstate(over="ignore"):
            own = mix64(own)
            tables += [self._cells(self._window(sums, np.maximum(before - k, 0), before) + own, FIRST + len(RAW) + j) for j, k in enumerate(SHAPE)]
        return words, more, ends, tables


def _events(body: str) -> np.ndarray:
    """For each character of a text what comes behind it: END, ON, or SKIP for marks and space between sentences."""
    e = np.full(len(body), ON, np.int8)
    for m in BOUNDARY.finditer(body):
        s = k = m.start()
        e[s : m.end()] = SKIP
        while k > 0:  # a sentence may end before its closing quotes
            e[k - 1] = END
            if body[k - 1] not in CLOSERS or body[s] not in ".!?…":
                break
            k -= 1
    if e[-1] == ON:
        e[-1] = END
    return e


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(texts: Iterator[tuple[str, int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, events, slots of the language) of some PIECE characters of texts (text, slot) at once: many texts, or a part
    of a long one with the characters before it."""
    codes: list[np.ndarray] = []
    events: list[np.ndarray] = []
    slots: list[int] = []

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = np.concatenate(codes), np.concatenate(events), np.repeat(slots, [len(c) for c in codes])
        for x in (codes, events, slots):
            x.clear()
        return out

    zeros, skipped, size = np.zeros(PAD, np.uint32), np.full(PAD, SKIP, np.int8), 0
    for text, slot in texts:
        c, e = _codes(text), _events(text)
        for start in range(0, len(c), PIECE):
            lo, hi = max(0, start - OVERLAP), min(len(c), start + PIECE)
            part = e[lo:hi].copy()
            part[: start - lo] = SKIP
            codes += [zeros, c[lo:hi]]
            events += [skipped, part]
            slots += [slot, slot]
            size += hi - lo + PAD
            if size >= PIECE:
                yield joined()
                size = 0
    if codes:
        yield joined()


def _language_slot(lang: str) -> int:
    return TABLES * SPAN + 2 * (xxhash.xxh32_intdigest(lang.encode()) % LANGUAGES)


def _counted(texts: DataFrame, without: Broadcast | None) -> DataFrame:
    """(part, counts) of texts (text, lang, h): the tables of each task, PART slots a row as planes of bytes, of which the
    higher ones are nearly all zero. Texts in the filter `without` are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, counts = Contexts(), np.zeros(SLOTS, np.int64)

        def bodies() -> Iterator[tuple[str, int]]:
            for batch in batches:
                if without is not None:
                    batch = batch.filter(pa.array(~passes(batch.column(2), without.value)))
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if body := without_remnant(text):
                        yield body, _language_slot(lang)

        waiting: list[list[np.ndarray]] = [[] for _ in range(TABLES + 1)]

        def count(t: int) -> None:
            size = min(SPAN, SLOTS - t * SPAN)
            counts[t * SPAN : t * SPAN + size] += np.bincount(np.concatenate(waiting[t]), minlength=size)
            waiting[t].clear()

        for codes, events, slots in _pieces(bodies()):
            words, more, ends, tables = contexts(codes, events < SKIP, slots)
            event = events[ends].astype(np.int64)
            found = [cells + more[at] for at, cells in words] + [cells + event for cells in tables] + [slots[ends] + event]
            for t, cells in enumerate(found):
                waiting[t].append((cells.ravel() - t * SPAN).astype(np.int32))
                if sum(map(len, waiting[t])) > FLUSH:
                    count(t)
        for t in range(TABLES + 1):
            if waiting[t]:
                count(t)
        if counts.any():
            for part, start in enumerate(range(0, SLOTS, PART)):
                held = counts[start : start + PART]
                if held.any():
                    planes = held.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([planes], pa.binary())], names=["part", "counts"])

    return texts.select("text", "lang", "h").mapInArrow(run, "part int, counts binary")


def _summed(parts: DataFrame) -> DataFrame:
    """(part, counts): the sums over all tasks, as float32. A task adds up row by row, so it holds its parts only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, planes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()
                sums[part] = sums[part] + held if part in sums else held
        for part, held in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([held.astype(np.float32).tobytes()], pa.binary())], names=["part", "counts"])

    return parts.repartition("part").mapInArrow(run, "part int, counts binary")


def language(lang: Column) -> Column:
    return F.coalesce(F.lower(F.trim(lang)), F.lit("und"))


def train(docs: DataFrame) -> np.ndarray:
    """The counts of the model over docs (text, lang, h): SLOTS float32, 46 MB for any corpus.

    Copies of a text are one witness: texts whose hash occurs again are told by a filter, brought together and counted
    once; all others are counted where they are.
    """
    held = docs.where(F.col("text").isNotNull())
    copied = cut_lineage(held.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    if copied.isEmpty():
        parts = _counted(held, None)
    else:
        known = docs.sparkSession.sparkContext.broadcast(hash_filter(copied))

        def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(passes(batch.column(2), known.value)))

        copies = held.select("text", "lang", "h").mapInArrow(among, "text string, lang string, h bigint")
        once = copies.groupBy("h", "text").agg(F.min("lang").alias("lang"))
        parts = _counted(held, known).union(_counted(once, None))
    counts = np.zeros(SLOTS, np.float32)
    for r in _summed(parts).collect():  # SLOTS cells in all
        values = np.frombuffer(r.counts, np.float32)
        counts[r.part * PART : r.part * PART + len(values)] = values
    return counts


class Model:
    """Log-odds of continuation from the counts."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        tables = counts[: TABLES * SPAN].reshape(TABLES, ROWS * CELLS * 2)
        self.noise = np.median(tables.reshape(TABLES, -1, 2).sum(axis=2), axis=1).astype(np.float64)  # what unrelated contexts leave in a cell
        ends = counts[TABLES * SPAN :].reshape(-1, 2).sum(axis=0, dtype=np.float64)
        self.usual = (ends[END] + 1) / (ends.sum() + 20)

    def _of(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ends, continuations) of the row with the lesser count; the text itself, which ended here, is taken off."""
        end, on = self.counts[cells].astype(np.float64), self.counts[cells + 1].astype(np.float64)
        row = (end + on).argmin(axis=0)
        pick = np.arange(cells.shape[1])
        return np.maximum(end[row, pick] - 1, 0), on[row, pick]

    def base(self, slots: np.ndarray) -> np.ndarray:
        """Chance of an end for each language."""
        end, on = self.counts[slots].astype(np.float64), self.counts[slots + 1].astype(np.float64)
        return (end + 100 * self.usual) / (end + on + 100)

    def blended(self, tables: list[tuple[np.ndarray, np.ndarray]], first: int, base: np.ndarray) -> np.ndarray:
        """Log-odds of continuation, blended from the first table to the last; tables: texts asked for, their cells."""
        p = base.copy()
        for t, (of, cells) in enumerate(tables, first):
            end, on = self._of(cells)
            own = np.maximum(0, 1 - self.noise[t] / np.maximum(end + on, 1))
            weight = WEIGHT + NOISE * self.noise[t]
            p[of] = (end * own + weight * p[of]) / ((end + on) * own + weight)
        p = np.clip(p, 1e-7, 1 - 1e-7)
        return np.log((1 - p) / p)


def score(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, lang, kind, n_chars, n_bytes, h, ratio) of each document; h: hash of the text; ratio: log-odds
    of a cut against an ending, null for closed and empty texts and those of remnants only."""
    text = F.col("text").cast("string")
    docs = docs.select(
        "doc_id", text.alias("text"), F.col("source").cast("string").alias("source"), language(F.col("lang")).alias("lang"),
        F.char_length(text).alias("n_chars"), F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("h"),
    )
    counts = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, contexts = Model(counts.value), Contexts()
        for batch in batches:
            kinds, asked, codes, slots = [], [], [], []
            for k, (t, lang) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())):
                kind, _ = tail(t)
                kinds.append(kind)
                if kind in OPEN and (body := without_remnant(t)):
                    asked.append(k)
                    codes.append(_codes(body[-TAIL:]))
                    slots.append(_language_slot(lang))
            ratio = np.full(len(kinds), np.nan)
            step = PIECE // (TAIL + PAD)
            for start in range(0, len(asked), step):
                some = slice(start, start + step)
                ratio[asked[some]] = _ratios(model, contexts, codes[some], np.array(slots[some], np.int64))
            columns = [batch.column(0), *(batch.column(k) for k in range(2, 7)), pa.array(kinds), pa.array(ratio, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "lang", "n_chars", "n_bytes", "h", "kind", "ratio"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, source string, lang string, n_chars int, n_bytes int, h bigint, kind string, ratio double"
    return docs.select("doc_id", "text", "source", "lang", "n_chars", "n_bytes", "h").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def _ratios(model: Model, contexts: Contexts, codes: list[np.ndarray], slots: np.ndarray) -> np.ndarray:
    zeros = np.zeros(PAD, np.uint32)
    every = np.concatenate([x for c in codes for x in (zeros, c)])
    final = np.cumsum([len(c) + PAD for c in codes]) - 1
    counted = np.zeros(len(every), bool)
    counted[final] = True
    words, _, ends, tables = contexts(every, counted, np.repeat(slots, [len(c) + PAD for c in codes]))
    base = model.base(slots)
    usual = np.log((1 - base) / base)
    where = np.searchsorted(final, ends)
    asked = [(where, cells) for cells in tables]
    of_raw = model.blended(asked[: len(RAW)], FIRST, base) - usual
    of_shape = model.blended(asked[len(RAW) :], FIRST + len(RAW), base) - usual
    of_word = model.blended([(np.searchsorted(final, at), cells) for at, cells in words], 0, np.full(len(codes), 0.5))
    # inside a word an end can't be right, unless the shape says that names end texts; a short last word is no name
    reach = np.minimum(of_shape, 0)
    reach[np.searchsorted(final, words[2][0])] = 0
    ratio = np.where(of_word > 1, np.maximum(of_raw + of_shape, of_word + 2 + reach), of_raw + of_shape)
    return np.clip(ratio, -12, 12)


def _limits(scored: DataFrame) -> DataFrame:
    """(source, size) of the lengths, in characters or bytes, at which open ends of different texts of a source pile up."""
    sizes = scored.where(F.col("kind").isin(*OPEN)).select("source", "h", "n_chars", "n_bytes").distinct().select("source", F.explode(F.array_distinct(F.array("n_chars", "n_bytes"))).alias("size"))
    by_size = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    usual = F.avg("n").over(Window.partitionBy("source"))  # one row for each length: small, whatever the source's size
    return by_size.withColumn("usual", usual).where((F.col("n") >= 5) & (F.col("n") >= 6 * F.col("usual"))).select("source", "size")


def _thresholds(binned: DataFrame) -> DataFrame:
    """(source, lang, kind, at_limit, prior): log-odds that an open end of this group is a cut, by expectation maximisation.

    The rate of a source comes first; the rate of each of its languages is drawn to it as by SHRINK further ends. A group has
    at most 49 bins; languages and kinds of a source are few, so a task holds a small table. At a limit the prior is at
    least what the counts say: the ends there against those endings that the source's other lengths let expect at one
    length (n_lengths: lengths in use).
    """
    import pandas as pd

    def rate_of(g: pd.DataFrame, rate: float = 0.5, weight: float = 2.0) -> float:
        ratio, n = g["bin"].to_numpy() / 2.0, g["n"].to_numpy(float)
        usual = rate
        for _ in range(40):
            p = 1 / (1 + np.exp(-(ratio + np.log(rate / (1 - rate)))))
            rate = min(max((float((p * n).sum()) + usual * weight) / (n.sum() + weight), 1e-9), 1 - 1e-9)
        return rate

    def odds(rate: float) -> float:
        return float(np.log(rate / (1 - rate)))

    def fit(table: pd.DataFrame) -> pd.DataFrame:
        out = []
        source = table["source"].iloc[0]
        for kind, g in table.groupby("kind"):
            usual, limit = g[~g["at_limit"]], g[g["at_limit"]]
            rate = rate_of(usual) if len(usual) else 0.5
            for lang, of in usual.groupby("lang"):
                out.append((source, lang, kind, False, odds(rate_of(of, rate, SHRINK))))
            if len(limit):
                ratio, n = usual["bin"].to_numpy() / 2.0, usual["n"].to_numpy(float)
                whole = float((n * (ratio > -6) / (1 + np.exp(ratio + odds(rate)))).sum())  # complete, and not by a colophon
                rate = rate_of(limit)
                counted = float(np.log((limit["n"].sum() + 1) / (whole / max(1, table["n_lengths"].iloc[0]) + 0.05)))
                for lang, of in limit.groupby("lang"):
                    out.append((source, lang, kind, True, max(odds(rate_of(of, rate, SHRINK)), counted)))
        return pd.DataFrame(out, columns=["source", "lang", "kind", "at_limit", "prior"])

    return binned.groupBy("source").applyInPandas(fit, "source string, lang string, kind string, at_limit boolean, prior double")


def truncated(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, kind, is_cut, odds) of every document of docs (doc_id, text, lang, source; more are ignored).

    is_cut: the text ends inside a word or sentence. odds = log-odds of the n-gram model plus those of the document's
    group, fitted on the whole corpus: its source, its language, how the end is marked, and whether its length is one at
    which the open ends of the source pile up. Null, empty and blank texts, texts of dots or remnants only and texts closed
    by a mark are none (odds null). Every row is judged, repeated ones too; a null source and doc_id are values of their
    own, a null lang is `und`. An empty table gives no rows.
    """
    scored = cut_lineage(score(docs))
    limits = _limits(scored)
    of = lambda c, name: limits.select(F.col("source").alias(f"s_{name}"), F.col("size").alias(f"v_{name}"), F.lit(True).alias(name))
    open_ = scored.where(F.col("ratio").isNotNull())
    a, b = of("n_chars", "by_chars"), of("n_bytes", "by_bytes")
    open_ = open_.join(a, F.col("source").eqNullSafe(F.col("s_by_chars")) & (F.col("n_chars") == F.col("v_by_chars")), "left")
    open_ = open_.join(b, F.col("source").eqNullSafe(F.col("s_by_bytes")) & (F.col("n_bytes") == F.col("v_by_bytes")), "left")
    open_ = open_.withColumn("at_limit", F.coalesce("by_chars", "by_bytes", F.lit(False))).select("row", "source", "lang", "kind", "at_limit", "h", "ratio")
    once = open_.groupBy("source", "lang", "kind", "at_limit", "h").agg(F.min("ratio").alias("ratio"))
    binned = once.groupBy("source", "lang", "kind", "at_limit", F.round(F.col("ratio") * 2).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    lengths = scored.groupBy(F.col("source").alias("l_source")).agg(F.count_distinct("n_chars").alias("n_lengths"))
    priors = _thresholds(binned.join(lengths, F.col("source").eqNullSafe(F.col("l_source"))).drop("l_source"))
    p = priors.select(*(F.col(c).alias(f"p_{c}") for c in ("source", "lang", "kind", "at_limit")), "prior")
    same = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("lang") == F.col("p_lang")) & (F.col("kind") == F.col("p_kind")) & (F.col("at_limit") == F.col("p_at_limit"))
    odds = open_.join(p, same).select("row", (F.col("ratio") + F.col("prior")).alias("odds"))
    out = scored.drop("ratio", "n_chars", "n_bytes", "h").join(odds, "row", "left")
    return out.withColumn("is_cut", F.coalesce(F.col("odds") > 0, F.lit(False))).select("doc_id", "source", "lang", "kind", "is_cut", "odds")


def report(judged: DataFrame) -> DataFrame:
    """(source, n_docs, n_cut, cut_share) of truncated()."""
    return judged.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("is_cut").alias("n_cut")).withColumn("cut_share", F.col("n_cut") / F.col("n_docs"))
