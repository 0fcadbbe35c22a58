"""Normalising file names and finding duplicates among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut_at_boundary(stem: Column, most: int = 80, least: int = 40) -> Column:
    """At most `most` characters, cut at the last `_` or `-` if that leaves more than `least`."""
    head = F.substring(stem, 1, most)
    kept = F.regexp_extract(head, r"^(.*)[_\-][^_\-]*$", 1)
    return F.when(F.char_length(stem) <= most, stem).when(F.char_length(kept) > least, kept).otherwise(head)


def clean_file_name(name: Column, prefixes: Sequence[str] = ()) -> Column:
    """Stem without one of the prefixes, `_` not doubled, at most 80 characters, no `_` or `-` at its ends, and the extension."""
    extension = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "_+", "_")
    if prefixes:
        stem = F.regexp_replace(stem, "(?i)^(?:" + "|".join(rf"\Q{p}\E" for p in prefixes) + ")", "")
    stem = F.regexp_replace(cut_at_boundary(stem), r"^[_\-]+|[_\-]+$", "")
    return F.concat(F.regexp_replace(stem, "_+", "_"), extension)


def without_author_prefix(stem: Column) -> Column:
    """A stem `Author-Title_by_Author...` (or `de`) without the author in front, whose first word comes again behind the title."""
    return F.regexp_replace(stem, r"(?i)^([^-_]+)[^-]*-((?:.*[^\p{L}\p{N}])?(?:by|de)_+\1.*)$", "$2")


def without_repeated_phrase(stem: Column) -> Column:
    """A stem in which the same run of two or more words, joined by `_`, follows on itself has it once."""
    return F.regexp_replace(stem, r"(?i)(^|[_\-])((?:[^_\-]+_)+[^_\-]+)[_\-]\2(?=$|[_\-])", "$1$2")


def copy_stem(name: Column) -> Column:
    """The name without a mark of a copy or revision before its extension, in lower case."""
    return F.lower(F.regexp_replace(name, r"(?i)(?: \(copy\)|_[0-9]+|_rev|-v[0-9]+|_[0-9]+(?:st|nd|rd|th)_ed)?\.[^.]*$", ""))


def duplicate_files(files: DataFrame, name: str = "source_file") -> DataFrame:
    """(stem, n_files, first_name) of names that differ only by copy marks and extension."""
    return files.where(F.col(name).isNotNull()).groupBy(copy_stem(F.col(name)).alias("stem")).agg(F.count(F.lit(1)).alias("n_files"), F.min(name).alias("first_name")).where("n_files > 1")


def rename_plan(files: DataFrame, target: Column, name: str = "source_file") -> DataFrame:
    """(old_name, new_name): names that collide get `_1`, `_2` ... before the extension, in order of the old name."""
    w = Window.partitionBy("t").orderBy("old_name")
    rows = files.select(F.col(name).alias("old_name"), target.alias("t")).where(F.col("old_name").isNotNull()).distinct().withColumn("k", F.row_number().over(w) - 1)
    return rows.select("old_name", F.when(F.col("k") == 0, F.col("t")).otherwise(F.concat(F.regexp_replace("t", r"\.[^.]*$", ""), F.lit("_"), F.col("k").cast("string"), F.regexp_extract("t", r"(\.[^.]*)$", 1))).alias("new_name"))
