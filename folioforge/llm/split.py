"""Splitting oversized texts at natural boundaries, in one regular expression and array functions.

The pattern takes as much as the limit allows and tries boundaries from strong to weak: end of text, paragraph, sentence,
clause, word, then any character that doesn't tear a combining sequence. Matches follow one another without gaps, so they
join up to the text. Each piece but the first then starts with the end of the match before it: the overlap, cut back to
the start of a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import one_per_record


def boundary_pattern(low: Column, high: Column) -> Column:
    """Pattern for pieces of low to high characters (code points)."""
    span = F.concat(F.lit(".{"), low.cast("string"), F.lit(","), high.cast("string"), F.lit("}"))
    most = F.concat(F.lit(".{1,"), high.cast("string"), F.lit("}"))
    return F.concat(
        F.lit("(?sU)"), most, F.lit(r"\z|"),
        span, F.lit(r"(?<=\n\n)(?!\n)|"),
        span, F.lit(r"(?<=[.!?…]['\"”’»)\]]{0,3}\s)(?!\s)|"),
        span, F.lit(r"(?<=[,;:—]\s)(?!\s)|"),
        span, F.lit(r"(?<=\s)(?!\s)|"),
        span, F.lit(r"(?![\p{M}\x{200D}\x{FE0E}\x{FE0F}\x{1F3FB}-\x{1F3FF}])(?<!\x{200D})|"),
        most,
    )


def format_of(source_file: Column) -> Column:
    """Lower-case extension after the last dot; empty without a dot, null for null."""
    return F.lower(F.regexp_extract(source_file, r"\.([^.]*)$", 1))


def split_oversized(records: DataFrame, limits: DataFrame, *, key: str = "node_id", text: str = "text", other: str = "other") -> DataFrame:
    """(key, parent_id, child_id, piece_no, text, overlap_chars) of the pieces of every record whose text is over its format's limit.

    overlap_chars: characters at the start that the piece before ends with; without them the pieces join up to the text.

    records: key, parent_id, child_id, source_file and text; more columns are ignored. limits: file_format, max_chars,
    overlap_chars, one row for each format and one named by `other` for the rest; a null overlap counts as 0, one of more
    than half of the limit as half. Pieces have at most max_chars characters. child_id is the record's with `_` and the
    number of the piece from 1 (a null one counts as `child`); parent_id stays. Null, empty and short texts have no
    pieces. Rows of one key are one record, rows of a null key one each. The limits are one row a format; more than 10,000
    of them raise an error.
    """
    rows = limits.where(F.col("max_chars") >= 1).dropDuplicates(["file_format"]).select("file_format", "max_chars", "overlap_chars").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("split limits: more than 10,000 formats")
    named = F.create_map(*(F.lit(x) for r in rows if r.file_format is not None for x in (r.file_format, f"{r.max_chars},{min(r.overlap_chars or 0, r.max_chars // 2)}")))
    setting = F.split(F.coalesce(F.try_element_at(named, format_of(F.col("source_file"))), F.try_element_at(named, F.lit(other))), ",")
    base = records.select(F.col(key), "parent_id", "child_id", F.col(text).alias("text"), setting[0].cast("int").alias("limit"), setting[1].cast("int").alias("overlap"))
    over = one_per_record(base.where(F.char_length("text") > F.col("limit")), key)
    high = F.col("limit") - F.col("overlap")
    low = F.greatest(F.lit(1), F.col("overlap"), (high / 2).cast("int"))
    parts = over.withColumn("parts", F.regexp_extract_all("text", boundary_pattern(low, high), F.lit(0)))

    def with_overlap(part: Column, k: Column) -> Column:
        before = F.right(F.col("parts")[k - 1], F.col("overlap"))
        # a window that starts inside a word gives way to the next word start, if it has one
        torn = F.substring(F.col("parts")[k - 1], F.char_length(F.col("parts")[k - 1]) - F.col("overlap"), F.lit(1)).rlike(r"(?U)\S") & before.rlike(r"(?U)^\S+\s+\S")
        back = F.when(torn, F.regexp_replace(before, r"(?U)^\S+\s+", "")).otherwise(before)
        shared = F.when((k == 0) | (F.col("overlap") == 0), F.lit("")).otherwise(back)
        return F.struct(F.concat(shared, part).alias("text"), F.char_length(shared).alias("overlap_chars"))

    pieces = parts.select(key, "parent_id", "child_id", F.posexplode(F.transform("parts", with_overlap)).alias("at", "piece"))
    number = (F.col("at") + 1).cast("int")
    return pieces.select(key, "parent_id", F.concat_ws("_", F.coalesce("child_id", F.lit("child")), number.cast("string")).alias("child_id"), number.alias("piece_no"), "piece.text", "piece.overlap_chars")
