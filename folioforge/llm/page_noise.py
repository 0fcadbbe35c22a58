"""Noise in text from scanned pages: label the lines with a hidden Markov model, drop page furniture, rejoin words, correct
misread ones, and set the rest as paragraphs.

The states of a line are body, header, header beside a page number, page number, heading and break. Its observation is a
vector of layout features: length against the page, likeness to the book's names, numbers and where they stand, letter
case, how it starts and ends, and its place in the text. A state emits each feature by itself. Start values of the model
are stated below; they are re-estimated from the labels of the whole corpus, whose counts are a few hundred cells. The
labels alone decide what becomes of a line. Words are judged by a vocabulary of all texts that aren't scans: words of at
least `word_share` of their tokens, so at most 1 / word_share of them. A word out of it is misread if usual confusions of
characters, or joining spaced letters, lead back into it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import one_per_record
from folioforge.session import cut_lineage

SCANS = ("pdf",)
KINDS = ("hyphenation", "misread", "running_header", "page_number")

#: Fixed values: (printed, read) confusions of characters in scanned text.
CONFUSIONS = (
    ("o", "0"), ("l", "1"), ("i", "!"), ("i", "1"), ("i", "l"), ("l", "i"), ("g", "9"), ("b", "6"), ("s", "5"), ("e", "c"), ("c", "e"), ("t", "f"), ("s", "f"),
    ("n", "ri"), ("d", "cl"), ("u", "ii"), ("h", "li"), ("w", "vv"), ("m", "rn"), ("rn", "m"), ("cl", "d"), ("ri", "n"), ("li", "h"), ("l", "|"), ("i", "|"),
)

BODY, HEADER, HEADER_PAGE, PAGE, HEADING, BREAK = range(6)
STATES = 6
#: Start values: chance of each value of a feature in the states, in the order above.
FEATURES = {
    "size": (  # blank, under 0.25, 0.45, 0.7 of the longest line, longer
        (1e-9, 0.03, 0.04, 0.05, 0.88), (1e-9, 0.20, 0.45, 0.30, 0.05), (1e-9, 0.10, 0.40, 0.40, 0.10),
        (1e-9, 0.90, 0.05, 0.03, 0.02), (1e-9, 0.60, 0.30, 0.08, 0.02), (1.0, 1e-12, 1e-12, 1e-12, 1e-12),
    ),
    "names": (  # likeness to the nearest of the book's names: below 0.6, 0.78, 0.9, above
        (0.975, 0.020, 0.0045, 0.0005), (0.001, 0.009, 0.09, 0.90), (0.001, 0.009, 0.09, 0.90),
        (0.997, 0.001, 0.001, 0.001), (0.90, 0.08, 0.015, 0.005), (0.997, 0.001, 0.001, 0.001),
    ),
    "number": (  # none, alone, alone in Roman capitals, at an end behind a gap, at an end
        (0.975, 0.0005, 0.0005, 0.002, 0.022), (0.985, 0.001, 0.001, 0.003, 0.010), (0.001, 0.001, 0.001, 0.80, 0.197),
        (0.001, 0.996, 0.001, 0.001, 0.001), (0.50, 0.005, 0.05, 0.22, 0.225), (0.996, 0.001, 0.001, 0.001, 0.001),
    ),
    "case": (  # no letters, starts small, starts with a capital, all capitals, capitals at nearly all words
        (0.005, 0.60, 0.38, 0.002, 0.013), (0.001, 0.010, 0.05, 0.45, 0.489), (0.001, 0.010, 0.05, 0.45, 0.489),
        (0.75, 0.15, 0.08, 0.01, 0.01), (0.05, 0.10, 0.25, 0.40, 0.20), (0.996, 0.001, 0.001, 0.001, 0.001),
    ),
    "end": (  # nothing, full stop or the like, hyphen, comma or the like, letter, digit or bracket
        (0.005, 0.25, 0.10, 0.07, 0.57, 0.005), (0.01, 0.20, 0.001, 0.005, 0.78, 0.004), (0.002, 0.10, 0.001, 0.001, 0.35, 0.546),
        (0.05, 0.10, 0.05, 0.01, 0.10, 0.69), (0.01, 0.15, 0.005, 0.15, 0.185, 0.50), (0.995, 0.001, 0.001, 0.001, 0.001, 0.001),
    ),
    "start": (  # other, a word of headings, a dash or bullet
        (0.990, 0.004, 0.006), (0.998, 0.001, 0.001), (0.998, 0.001, 0.001), (0.75, 0.001, 0.249), (0.30, 0.40, 0.30), (0.998, 0.001, 0.001),
    ),
    "place": (  # inside the text, first line, last line, only line
        (0.77, 0.09, 0.09, 0.05), (0.84, 0.10, 0.05, 0.01), (0.84, 0.10, 0.05, 0.01), (0.64, 0.05, 0.30, 0.01), (0.35, 0.35, 0.25, 0.05), (0.94, 0.02, 0.02, 0.02),
    ),
    "above": (  # no line or a blank one, one that is short or ends as sentences do, a long one that goes on
        (0.20, 0.20, 0.60), (0.30, 0.20, 0.50), (0.30, 0.20, 0.50), (0.50, 0.20, 0.30), (0.70, 0.27, 0.03), (0.05, 0.45, 0.50),
    ),
}
SIZES = tuple(len(v[0]) for v in FEATURES.values())
OFFSETS = tuple(np.cumsum((0, *SIZES))[:-1].tolist())
VALUES = sum(SIZES)
#: Start values: chances of the next state, and of the first one in the last row.
MOVE = (
    (0.85, 0.02, 0.01, 0.03, 0.02, 0.07), (0.45, 0.01, 0.01, 0.20, 0.03, 0.30), (0.55, 0.01, 0.01, 0.03, 0.05, 0.35),
    (0.55, 0.12, 0.03, 0.01, 0.04, 0.25), (0.60, 0.02, 0.01, 0.03, 0.29, 0.05), (0.50, 0.15, 0.05, 0.15, 0.05, 0.10),
    (0.70, 0.05, 0.03, 0.08, 0.12, 0.02),
)
ROUNDS = 1  # passes of re-estimation over the corpus
PRIOR = 50.0

_NUMBER = r"(?:\d{1,4}|(?=[ivxlc])c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3}))"
PAGE_LINE = re.compile(rf"[\s\[(—–\-~*·.]*(?:(?:page|pg\.?|p\.)\s*)?{_NUMBER}[\s\])—–\-~*·.]*\Z", re.I)
UPPER_ROMAN = re.compile(r"[^a-z\d]*[IVXLC]+[^a-z\d]*\Z")
LEADING = re.compile(rf"\s*[\[(—–\-]*\s*(?:(?:page|pg\.?|p\.)\s*)?({_NUMBER})[\])—–\-.]*[\s|·]+(?=\S)", re.I)
TRAILING = re.compile(rf"(?<=\S)[\s|·]+[\[(—–\-]*\s*(?:(?:page|pg\.?|p\.)\s*)?({_NUMBER})[\])—–\-.]*\s*\Z", re.I)
NUMERAL = re.compile(rf"[\[(—–\-]*{_NUMBER}[\])—–\-.]*\Z", re.I)
PAGE_WORD = re.compile(r"(?:page|pg|p)\b", re.I)
HEADING_WORDS = frozenset(("chapter", "section", "hymn", "part", "book", "psalm", "lecture", "sermon"))
BROKEN_END = re.compile(r"([^\W\d_][^\s\W_]*)(?P<mark>[-‐‑=¬\xad])[ \t]*\Z")
HYPHENS = "-‐‑=¬\xad"
TOKEN = re.compile(r"[^\s\"“”—–,.;:?()\[\]\-‐‑=¬\xad]+")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_] ){2,}[^\W\d_](?![^\W_])")
JOIN_ENDS = frozenset(("", " ", ".", ",", ";", ":", "?", '"'))
SPACED_END = re.compile(r"(?<![^\W_])(?:[^\W\d_] ){2,}[^\W\d_]\Z")
INLINE = re.compile(r"([^\W\d_]+)([-‐‑=¬\xad]) +([a-zà-ÿ][^\W_]*)")
LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def canonical(text: str) -> str:
    """Letters and digits of text in one of the forms that confusions can't tell apart."""
    t = re.sub(r"[\W_]+", "", text.lower().replace("!", "i").replace("|", "l"))
    for a, b in (("vv", "w"), ("rn", "m"), ("cl", "d"), ("ii", "u"), ("li", "h"), ("ri", "n")):
        t = t.replace(a, b)
    return t.translate(str.maketrans("0196|5cfs", "olgbltett"))


def _twos(text: str) -> frozenset[str]:
    return frozenset(text[k : k + 2] for k in range(len(text) - 1))


class Names:
    """The names of a book that a running header may repeat."""

    def __init__(self, *names: str | None) -> None:
        self.forms = [(c, _twos(c)) for n in names if n and (c := canonical(n))]
        sizes = [len(c) for c, _ in self.forms]
        self.least, self.most = min(sizes, default=0) - 4, max(sizes, default=0) + 12  # confusions of two characters for one

    def likeness(self, text: str) -> float:
        """To the nearest name, 1 for the same but for what confusions can't tell apart."""
        if not self.forms or not self.least <= len(text.replace(" ", "")) <= self.most:
            return 0.0
        c = canonical(text)
        best = 0.0
        twos = _twos(c)
        for f, held in self.forms:
            if c == f:
                return 1.0
            if len(f) >= 8 and abs(len(c) - len(f)) <= 4 and len(twos & held) >= 0.4 * len(held):
                best = max(best, SequenceMatcher(None, c, f, autojunk=False).ratio())
        return best


def observed(line: str, names: Names, width: int, place: int) -> tuple[int, ...]:
    """The features of a line, in the order of FEATURES but for the last one."""
    s = line.strip()
    if not s:
        return (0, 0, 0, 0, 0, 0, place)
    n = len(s)
    share = n / width
    size = 4 if share >= 0.7 else 3 if share >= 0.45 else 2 if share >= 0.25 else 1
    like, number = 0.0, 0
    if n <= 100:
        head, tail = s.split(None, 1)[0], s.rsplit(None, 1)[-1]
        if n <= 24 and PAGE_LINE.match(s):
            number = 2 if UPPER_ROMAN.match(s) and not any(ch.isdigit() for ch in s) else 1
        else:
            rest = s
            if tail is not s and (NUMERAL.match(tail) or NUMERAL.match(head) or PAGE_WORD.match(head)):
                found = [(names.likeness(s[: m.start()] + s[m.end() :]), m) for m in (LEADING.match(s), TRAILING.search(s)) if m]
                if found:
                    like, m = max(found, key=lambda x: x[0])
                    number, rest = (3 if re.search(r"\s{2}|\||·", m.group()) else 4), ""
            like = max(like, names.likeness(rest)) if rest else like
    else:
        head = s[:20]
    lead = s[0] if s[0].isalpha() else next(filter(str.isalpha, s), "")
    if number in (1, 2) and not PAGE_WORD.match(head):
        case = 0 if not lead else 3 if s.isupper() else 1
    elif not lead.isupper():
        case = 1 if lead else 0
    elif n > 1 and s.isupper():
        case = 3
    else:
        words = [w for w in s.split() if w[0].isalpha()] if n <= 100 else ()
        case = 4 if len(words) > 1 and sum(w[0].isupper() for w in words) >= 0.6 * len(words) else 2
    last = s[-1]
    end = 2 if last in HYPHENS else 1 if last in ".!?\"”’" else 3 if last in ",;:" else 4 if last.isalpha() else 5 if last.isdigit() or last in ")]" else 0
    first = head.lower().rstrip(".:")
    start = 1 if first in HEADING_WORDS and n <= 100 else 2 if s[0] in "-–—*•" else 0
    return (size, 3 if like >= 0.9 else 2 if like >= 0.78 else 1 if like >= 0.6 else 0, number, case, end, start, place)


def lines_of(text: str, names: Names) -> tuple[list[str], list[tuple[int, ...]]]:
    """The lines of a text and their features."""
    lines = text.split("\n")
    width, last = max(map(len, lines)) or 1, len(lines) - 1
    out: list[tuple[int, ...]] = []
    above = 0
    for k, line in enumerate(lines):
        size, *rest = observed(line, names, width, 3 if not last else 1 if k == 0 else 2 if k == last else 0)
        out.append((size, *rest, above))
        above = 0 if size == 0 else 2 if size >= 3 and rest[3] in (2, 3, 4) else 1
    return lines, out


class Labels:
    """Most likely states of lines; the scores of a vector of features and of a sequence of them are kept."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None) -> None:
        emit = start_values()[0] if emit is None else emit
        move = start_values()[1] if move is None else move
        self.emit, self.move, self.first = emit, move[:STATES], move[STATES]
        self.scores: dict[tuple[int, ...], np.ndarray] = {}
        self.known: dict[tuple[tuple[int, ...], ...], list[int]] = {}

    def score(self, features: tuple[int, ...]) -> np.ndarray:
        found = self.scores.get(features)
        if found is None:
            found = self.scores[features] = self.emit[:, [o + v for o, v in zip(OFFSETS, features)]].sum(axis=1)
        return found

    def __call__(self, lines: list[tuple[int, ...]]) -> list[int]:
        key = tuple(lines)
        states = self.known.get(key)
        if states is None:
            if len(self.known) > 100_000:
                self.known.clear()
            states = self.known[key] = self._best(lines)
        return states

    def _best(self, lines: list[tuple[int, ...]]) -> list[int]:
        score = self.first + self.score(lines[0])
        back = []
        for x in lines[1:]:
            step = score[:, None] + self.move
            best = step.argmax(axis=0)
            back.append(best)
            score = step[best, np.arange(STATES)] + self.score(x)
        states = [int(score.argmax())]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def start_values() -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the start values: states x values of all features, and moves with the first states in the last row."""
    emit = np.concatenate([np.array(v, float) / np.sum(v, axis=1, keepdims=True) for v in FEATURES.values()], axis=1)
    return np.log(emit), np.log(np.array(MOVE))


class Words:
    """The vocabulary and what can be put back into it."""

    def __init__(self, known: frozenset[str], compounds: frozenset[str]) -> None:
        self.known, self.compounds = known, compounds
        self.cache: dict[str, str | None] = {}
        self.plain: set[str] = set()  # tokens as they stand in texts that need no look

    def word(self, x: str) -> bool:
        return x in self.known

    def corrected(self, x: str) -> str | None:
        """The known word that x, lower case, was probably printed as; null if x is known or there is none."""
        if x in self.cache:
            return self.cache[x]
        if len(self.cache) > 500_000:
            self.cache.clear()
        found = None
        if not self.word(x) and 2 <= len(x) <= 60:
            once = list(self._undo(x))
            found = next((y for y in once if self.word(y)), None)
            if found is None and len(x) >= 4:
                found = next((z for y in once for z in self._undo(y) if self.word(z)), None)
        self.cache[x] = found
        return found

    @staticmethod
    def _undo(x: str) -> Iterator[str]:
        for printed, read in CONFUSIONS:
            at = x.find(read)
            while at >= 0:
                yield x[:at] + printed + x[at + len(read) :]
                at = x.find(read, at + 1)

    def rejoined(self, a: str, b: str, marked: bool) -> str | None:
        """What the two halves at a line end are together: a word, a compound or, after a hyphen, an unknown word."""
        if a + b in self.known or (marked and self.corrected(a + b)):
            if marked or not (a in self.known and b in self.known):
                return a + b
        if f"{a}-{b}" in self.compounds:
            return f"{a}-{b}"
        if marked and not (a in self.known and b in self.known):
            return a + b
        return None


def _match_case(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


def repair(text: str, names: Names, words: Words, labels: Labels) -> tuple[str, set[str]]:
    """(clean text, kinds of noise)."""
    noise: set[str] = set()
    text = html.unescape(text) if "&" in text else text
    lines, features = lines_of(text, names)
    states = labels(features)
    paragraphs: list[str] = []
    held: list[str] = []  # lines of the open paragraph; the last one may still take the rest of a word
    gap = False

    def close() -> None:
        if held:
            paragraphs.append(" ".join(held).strip())
            held.clear()

    for line, state in zip(lines, states):
        if state in (HEADER, HEADER_PAGE):
            noise.add("running_header")
            if state == HEADER_PAGE:
                noise.add("page_number")
        elif state == PAGE:
            noise.add("page_number")
        elif state == BREAK:
            gap = True
        elif state == HEADING:
            close()
            paragraphs.append(line.strip())
            gap = False
        else:
            body = line.strip()
            if gap and held and held[-1][-1:] in ".!?\"”’)" and not body[:1].islower():
                close()
            gap = False
            whole = _joined(held[-1], body, words) if held else None
            if whole is None:
                held.append(body)
            else:
                noise.add("hyphenation")
                held[-1] = whole
    close()
    return "\n\n".join(_words_of(p, words, noise) for p in paragraphs), noise


def _joined(above: str, body: str, words: Words) -> str | None:
    """The two lines as one if a word is broken between them."""
    start = LETTERS.match(body)
    if not start:
        return None
    if above[-1] in HYPHENS:
        last = above.rsplit(None, 1)[-1]
        end = BROKEN_END.search(last)
        if end:
            whole = words.rejoined(end.group(1).lower(), start.group().lower(), True)
            if whole:
                return above[: len(above) - len(last) + end.start("mark")] + ("-" if "-" in whole else "") + body
        return None
    if body[0].islower() and body[start.end() : start.end() + 1] in JOIN_ENDS:
        last = above.rsplit(None, 1)[-1]
        tail = LETTERS.search(last)
        if tail and tail.end() == len(last) and words.rejoined(tail.group().lower(), start.group().lower(), False) and not SPACED_END.search(above[-80:]):
            return above + body
    return None


def _words_of(text: str, words: Words, noise: set[str]) -> str:
    """One paragraph with its words put right."""

    def inline(m: re.Match) -> str:
        a, b = m.group(1).lower(), m.group(3).lower()
        if a + b in words.known and not (a in words.known and b in words.known):
            noise.add("hyphenation")
            return m.group(1) + m.group(3)
        return m.group()

    def spaced(m: re.Match) -> str:
        whole = m.group().replace(" ", "")
        low = whole.lower()
        if low in words.known or words.corrected(low):
            noise.add("misread")
            return _match_case(words.corrected(low) or low, whole)
        for k in range(1, len(low)):  # two spaced words, or a single letter beside one
            if low[:k] in words.known and low[k:] in words.known and len(low) > 3:
                noise.add("misread")
                return whole[:k] + " " + whole[k:]
        return m.group()

    if any(h + " " in text for h in HYPHENS):
        text = INLINE.sub(inline, text)
    if SPACED.search(text):
        text = SPACED.sub(spaced, text)
    strange = set(TOKEN.findall(text)) - words.plain
    for raw in list(strange):
        if words.word(raw.lower().strip("'’!")):
            strange.discard(raw)
            if len(words.plain) < 500_000:
                words.plain.add(raw)
    if not strange:
        return text
    odd = [m for m in TOKEN.finditer(text) if m.group() in strange]
    out, at, skip = [], 0, -1
    for m in odd:
        if m.start() < skip:
            continue
        raw = m.group()
        core = raw.strip("'’")
        low = core.lower()
        if not any(ch.isalpha() for ch in low) and not any(ch in "019!|" for ch in low):
            continue
        # spaced apart: with the next or the previous piece it is a word
        done = False
        after = re.match(r" ([^\W\d_]+)", text[m.end() :])
        before = re.search(r"([^\W\d_]+) \Z", text[max(at, m.start() - 40) : m.start()])
        if raw[-1:].isalpha() and after and (low + after.group(1).lower()) in words.known:
            noise.add("misread")
            out.append(text[at : m.start()] + raw + after.group(1))
            at = skip = m.end() + after.end()
            done = True
        elif before and (before.group(1).lower() + low.rstrip("!")) in words.known:
            noise.add("misread")
            out.append(text[at : m.start() - 1] + raw)
            at = m.end()
            done = True
        if done:
            continue
        for form in (low, low.rstrip("!"), low.lstrip("!")):
            right = words.corrected(form) if form else None
            if right:
                noise.add("misread")
                lead = raw.lower().find(form)
                out.append(text[at : m.start()] + raw[:lead] + _match_case(right, core) + raw[lead + len(form) :])
                at = m.end()
                break
    out.append(text[at:])
    return "".join(out)


def is_scan(source_file: Column, formats: tuple[str, ...] = SCANS) -> Column:
    """By the lower-case extension after the last dot; a null file is none."""
    return F.coalesce(F.lower(F.regexp_extract(source_file, r"\.([^.]*)$", 1)).isin(*formats), F.lit(False))


def vocabulary(records: DataFrame, text: str, word_share: float, formats: tuple[str, ...]) -> tuple[frozenset[str], frozenset[str]]:
    """(words, compounds at a hyphen) of the texts that aren't scans, of all texts if every one is a scan."""
    t = records.select(F.lower(F.col(text)).alias("t"), is_scan(F.col("source_file"), formats).alias("scan")).where(F.col("t").isNotNull())
    word = F.regexp_extract_all("t", F.lit(r"(?U)\p{L}+(?:['’]\p{L}+)*(?:-\p{L}+)*"), F.lit(0))
    counts = cut_lineage(t.select("scan", F.explode(word).alias("w")).groupBy("w").agg(F.count_if("scan").alias("n_scan"), F.count_if(~F.col("scan")).alias("n_clean")))
    total = counts.agg(F.sum("n_clean").alias("c"), F.sum("n_scan").alias("s")).first()
    use, n = ("n_clean", total.c) if total.c else ("n_scan", total.s or 0)
    kept = [r.w for r in counts.where(F.col(use) >= max(2.0, word_share * n)).select("w").collect()]  # at most 1 / word_share rows
    parts = {p for w in kept for p in w.split("-")}
    return frozenset(parts | set(kept)), frozenset(w for w in kept if "-" in w)


def _with_names(records: DataFrame, catalog: DataFrame, key: str, text: str, formats: tuple[str, ...]) -> DataFrame:
    names = catalog.where(F.col("source_file").isNotNull()).groupBy("source_file").agg(*(F.min(c).alias(c) for c in ("title", "short_title", "author")))
    if names.limit(100_001).count() <= 100_000:  # a hot book isn't shuffled; beyond that AQE splits it
        names = F.broadcast(names)
    chosen = records.where(is_scan(F.col("source_file"), formats) & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"), "source_file")
    return chosen.join(names, "source_file", "left").select("id", "text", "title", "short_title", "author")


class _NameCache:
    def __init__(self) -> None:
        self.known: dict[tuple, Names] = {}

    def __call__(self, *names: str | None) -> Names:
        if names not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[names] = Names(*names)
        return self.known[names]


def _train(lines: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The model re-estimated from its own labels over the whole corpus; the counts are states x values and states x states cells."""
    start = [np.exp(x) for x in start_values()]
    emit, move = start_values()
    size = STATES * VALUES

    def counted(batches: Iterator[pa.RecordBatch], emit: np.ndarray, move: np.ndarray) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[tuple[int, ...], ...]] = Counter()
        labels, cache = Labels(emit, move), _NameCache()
        cells = np.zeros(size + (STATES + 1) * STATES, np.int64)

        def add() -> None:
            for features, n in seen.items():
                states = labels(list(features))
                cells[size + STATES * STATES + states[0]] += n
                for s, x in zip(states, features):
                    for o, v in zip(OFFSETS, x):
                        cells[s * VALUES + o + v] += n
                for a, b in zip(states, states[1:]):
                    cells[size + a * STATES + b] += n
            seen.clear()

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(1, 5)]
            for text, *names in zip(*columns):
                if text:
                    seen[tuple(lines_of(html.unescape(text) if "&" in text else text, cache(*names))[1])] += 1
            if len(seen) > 20_000:
                add()
        add()
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(cells[used])], names=["cell", "n"])

    for _ in range(rounds):
        run = lambda batches, emit=emit, move=move: counted(batches, emit, move)
        counts = np.zeros(size + (STATES + 1) * STATES)
        for r in lines.mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            counts[r.cell] = r.n
        # the start values weigh as PRIOR lines a state
        e = counts[:size].reshape(STATES, VALUES) + PRIOR * start[0]
        for o, n in zip(OFFSETS, SIZES):
            e[:, o : o + n] /= e[:, o : o + n].sum(axis=1, keepdims=True)
        m = counts[size:].reshape(STATES + 1, STATES) + PRIOR * start[1]
        emit, move = np.log(e), np.log(m / m.sum(axis=1, keepdims=True))
    return emit, move


def repaired(
    records: DataFrame, catalog: DataFrame, *, key: str = "node_id", text: str = "text", formats: tuple[str, ...] = SCANS, word_share: float = 4e-6, with_text: bool = True
) -> DataFrame:
    """(key, noise array<string>, clean_text) of every record of a scanned book; clean_text only if with_text.

    noise: the kinds found, of hyphenation, misread, running_header and page_number, sorted. clean_text: continuous
    paragraphs, separated by a blank line, without headers and page numbers, words rejoined and corrected. A blank text
    gives an empty clean_text and no noise; null texts and books of other formats give no row. A file without a catalog
    row has no names to match. Rows of one key are one record when the text is asked for; without it repeated rows repeat.
    """
    known, compounds = vocabulary(records, text, word_share, formats)
    source = _with_names(records, catalog, key, text, formats)
    emit, move = _train(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, labels, cache = Words(known, compounds), Labels(emit, move), _NameCache()
        for batch in batches:
            found, clean = [], []
            columns = [batch.column(k).to_pylist() for k in range(1, 5)]
            for body, *names in zip(*columns):
                fixed, noise = repair(body, cache(*names), words, labels)
                found.append(sorted(noise))
                clean.append(fixed if with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string())), pa.array(clean, pa.string())], names=["id", "noise", "clean_text"])

    kind = records.schema[key].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, noise array<string>, clean_text string")
    out = one_per_record(out, "id") if with_text else out.drop("clean_text")
    return out.withColumnRenamed("id", key)
