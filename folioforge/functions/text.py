"""Text functions as Column -> Column expressions. Null in gives null out; an empty text gives an empty result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word character in the sense of Unicode letters, digits and the underscore, spelt out since \w differs between engines.
WORD = r"[\p{L}\p{N}_]"


def _lit(items: Sequence[str]) -> Column:
    return F.array(*(F.lit(x) for x in items)) if items else F.array().cast("array<string>")


def tidy_layout(text: Column) -> Column:
    """Tabs and runs of spaces to one space, hyphenated line ends joined, no space before punctuation or just inside
    quotes and brackets, at most one blank line between paragraphs, every line trimmed.

    A quote counts as an opening and as a closing one, so blanks on both of its sides go.
    """
    # fixed values: the patterns and their order decide the result
    steps = (
        (r"\t", " "),
        (r" {2,}", " "),
        (r"-[ \t\n\r\f\x0B]*\n[ \t\n\r\f\x0B]*", ""),
        (r"[ \t\n\r\f\x0B]+([,.;:!?])", "$1"),
        (r"([\"(\[])[ \t\n\r\f\x0B]+", "$1"),
        (r"[ \t\n\r\f\x0B]+([\")\]])", "$1"),
        (r"\n{3,}", "\n\n"),
    )
    for pattern, new in steps:
        text = F.regexp_replace(text, pattern, new)
    return F.array_join(F.transform(F.split(text, "\n"), lambda line: F.regexp_replace(line, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", "")), "\n")


def replace_words(text: Column, corrections: Mapping[str, str]) -> Column:
    """Each key, where it stands as whole words in any letter case, becomes its value; applied in the order given."""
    for wrong, right in corrections.items():
        text = F.regexp_replace(text, rf"(?i)(?<!{WORD})\Q{wrong}\E(?!{WORD})", right.replace("\\", r"\\").replace("$", r"\$"))
    return text


#: Common English words that say nothing about a passage; callers may pass any other list.
STOP_WORDS = tuple(
    """a about above after again all also although always am among an and another any are as at be because been before being below
    between both but by can cannot could did do does done down during each either else even ever every few for from further had has
    have he her here hers herself him himself his how however i if in into is it its itself just least less many may me might mine more
    most much must my myself neither never no nobody none nor not nothing now of off often on once one only or other others our ours
    out over own perhaps rather same seldom several she should since so some such than that the their theirs them themselves then there
    these they this those though through thus to too toward under until up upon us very was we well were what when where whether which
    while who whom whose why will with within without would yet you your yours""".split()
)


#: The characters that stay, and the order of the steps, which decides the result.
def plain_text(text: Column) -> Column:
    """White space to single spaces, characters other than letters, digits, `_` and `.,;:!?-'"` to spaces, trimmed."""
    squeezed = F.regexp_replace(text, r"(?U)\s+", " ")
    kept = F.regexp_replace(squeezed, r"[^\p{L}\p{N}_ .,;:!?\-'\"]", " ")
    return F.trim(F.regexp_replace(kept, r" +", " "))


def is_heading_line(line: Column, least: int = 10, share: float = 0.8) -> Column:
    """At least `least` characters after trimming and more than `share` of its letters upper case."""
    letters = F.char_length(F.regexp_replace(line, r"[^\p{L}]", ""))
    upper = F.char_length(F.regexp_replace(line, r"[^\p{Lu}]", ""))
    return (F.char_length(F.trim(line)) >= least) & (letters > 0) & (upper > letters * F.lit(share))


#: Fixed value: the pattern of a verse reference; (?U) makes classes and word boundaries those of Unicode.
VERSE = r"(?U)\b(?:\d\s)?[A-Z][a-z]+(?:\s[A-Z][a-z]+)?\s\d+:\d+(?:-\d+)?(?:,\s?\d+)*\b"


def verse_references(text: Column) -> Column:
    """References such as `Name 3:16` or `1 Name 13:4-7, 9`; a capitalised word just before the name is part of it."""
    return F.regexp_extract_all(text, F.lit(VERSE), F.lit(0))


def contained_terms(text: Column, terms: Sequence[str]) -> Column:
    """Terms that occur anywhere in the text, in any letter case, in the order given."""
    low = F.lower(text)
    return F.filter(_lit(terms), lambda t: F.contains(low, F.lower(t)))


def whole_terms(text: Column, terms: Sequence[str]) -> Column:
    """Terms that occur as whole words, in any letter case, in the order given and as written there."""
    low = F.lower(text)
    return F.filter(_lit(terms), lambda t: F.regexp_like(low, F.concat(F.lit(rf"(?<!{WORD})\Q"), F.lower(t), F.lit(rf"\E(?!{WORD})"))))


def split_items(text: Column) -> Column:
    """A comma-separated field as its distinct trimmed items without blanks, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))


def trimmed_items(items: Column) -> Column:
    """An array of items trimmed of ASCII white space, without null, blank and repeated ones."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: F.regexp_replace(x, r"^[ \t\n\r]+|[ \t\n\r]+$", "")), lambda x: x.isNotNull() & (x != "")))


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space."""
    return F.size(F.filter(F.split(text, r"[ \t\n\r\f\x0B]+"), lambda x: x != ""))


def estimated_tokens(text: Column) -> Column:
    """A rough number of tokens: a quarter of the characters, rounded down; null for null."""
    return F.floor(F.char_length(text) / 4)


def number_kind(value: Column) -> Column:
    """`int`, `float` or `text`, by the form of a bare value; null for null."""
    form = F.when(value.rlike(r"^[+-]?[0-9]+$"), "int").when(value.rlike(r"^[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), "float")
    return F.when(value.isNotNull(), form.otherwise("text"))


def sentences(text: Column) -> Column:
    """Trimmed sentences: the text is cut after `.`, `!` or `?` with white space behind; blank ones are dropped."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])[ \t\n\r]+"), lambda x: F.trim(x)), lambda x: x != "")


def safe_name(text: Column) -> Column:
    """A folder name: characters other than letters, digits, `_` and `-` become `_`, runs of it one, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_\-]", "_"), "_+", "_"), "^_+|_+$", "")


def file_extension(path: Column) -> Column:
    """Lower-case extension after the last dot, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))


def without_markup(html: Column) -> Column:
    """Text of an HTML document: scripts, styles and comments dropped, tags to spaces, common entities decoded."""
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    body = F.regexp_replace(body, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#10;", "\n"), ("&amp;", "&")):
        body = F.replace(body, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(body, r"[ \t\n\r]+", " "))


def ordered_case(value: Column, rules: Sequence[tuple[str, object]], default: object) -> Column:
    """The value of the first rule whose text is contained in `value`, in any letter case."""
    low, out = F.lower(value), None
    for part, result in rules:
        hit = F.contains(low, F.lit(part.lower()))
        out = F.when(hit, F.lit(result)) if out is None else out.when(hit, F.lit(result))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
