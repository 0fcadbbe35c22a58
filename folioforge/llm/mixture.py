"""Mixing sources to target weights: repetition rates from token totals, then a seeded draw for each document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.tokenize import DEFAULT_VOCABULARY, encode
from folioforge.session import cut_lineage

LISTED = 100_000  # sources whose rates may be broadcast
NAMED = 1_000  # sources that may stand in a filter


def sized(docs: DataFrame, targets: DataFrame, *, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents whose source has a target. Null and empty texts have 0 tokens."""
    named = targets.where(F.col("source").isNotNull()).select("source").distinct()
    few = [r.source for r in named.limit(NAMED + 1).collect()]
    rows = docs.select("doc_id", "source", "text")
    # a plain filter, where it is short, spares the plan with the vocabulary a join and its re-planning
    chosen = rows.where(F.col("source").isin(few)) if len(few) <= NAMED else rows.join(_small(named), "source", "left_semi")
    return cut_lineage(encode(chosen, vocabulary=vocabulary).select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens")))


def _small(named: DataFrame) -> DataFrame:
    """Broadcast below a checked size, so a hot source isn't shuffled; above it AQE splits skewed partitions."""
    return F.broadcast(named) if named.limit(LISTED + 1).count() <= LISTED else named


def rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each source with a target: target_share, max_repeats, n_docs, n_tokens, total_tokens, rate.

    rate = target_share * total_tokens / n_tokens, at most max_repeats; 0 for a source without tokens. total_tokens: all
    documents of these sources, each once. Repeated rows of targets count once, different ones of a source add up in share
    and have the least max_repeats. A null share is 0, a null or negative max_repeats is 0.
    """
    wanted = (
        targets.where(F.col("source").isNotNull()).select("source", "target_share", "max_repeats").distinct()
        .groupBy("source").agg(F.coalesce(F.sum("target_share"), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce(F.min("max_repeats"), F.lit(0)), F.lit(0)).alias("max_repeats"))
    )
    found = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    total = sizes.select(F.coalesce(F.sum("n_tokens"), F.lit(0))).scalar()
    zero = F.lit(0).cast("bigint")
    out = wanted.join(found, "source", "left").withColumns({"n_docs": F.coalesce("n_docs", zero), "n_tokens": F.coalesce("n_tokens", zero), "total_tokens": total})
    ideal = F.col("target_share") * F.col("total_tokens") / F.col("n_tokens")
    return out.withColumn("rate", F.when(F.col("n_tokens") > 0, F.least(ideal, F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0)))


def _copies(rows: DataFrame, rated: DataFrame, seed: int) -> DataFrame:
    """rows (doc_id, source, rest) that are used, with the number of their copies."""
    share = F.pmod(F.xxhash64(F.lit(seed), "source", "doc_id"), F.lit(1 << 53)).cast("double") / float(1 << 53)
    whole = F.floor("rate")
    joined = rows.join(_small(rated.select("source", "rate")), "source")
    return joined.withColumn("copies", (whole + F.when(share < F.col("rate") - whole, 1).otherwise(0)).cast("int")).where(F.col("copies") > 0).drop("rate")


def mix(sizes: DataFrame, rated: DataFrame, *, seed: int = 17) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of the documents used at least once.

    copies = floor(rate) + 1 with probability rate - floor(rate), decided by a hash of seed, source and doc_id: the same
    on every run and on any number of executors. Never more than max_repeats.
    """
    return _copies(sizes.select("doc_id", "source", "n_tokens"), rated, seed).select("doc_id", "source", "n_tokens", "copies")


def emit(docs: DataFrame, rated: DataFrame, *, seed: int = 17) -> DataFrame:
    """(doc_id, source, copy_no, text): the mixed corpus, every document as often as mix() says; a narrow map of docs.

    Null and empty texts come out as they are. Repeated rows of docs are documents of their own.
    """
    used = _copies(docs.select("doc_id", "source", "text"), rated, seed)
    return used.select("doc_id", "source", F.explode(F.sequence(F.lit(1), "copies")).alias("copy_no"), "text")


def report(mixed: DataFrame, rated: DataFrame) -> DataFrame:
    """Target and actual share of each source.

    actual_share: tokens used, repeats counted, over total_tokens; mixed_share: over all tokens used. A source that its
    max_repeats keeps below its target shows an actual_share below target_share.
    """
    used = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("docs_used"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens_used"))
    zero = F.lit(0).cast("bigint")
    out = rated.join(used, "source", "left").withColumns({c: F.coalesce(c, zero) for c in ("docs_used", "copies", "tokens_used")})
    everything = mixed.select(F.coalesce(F.sum(F.col("copies") * F.col("n_tokens")), zero)).scalar()
    over = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return out.select(
        "source", "target_share", "max_repeats", "n_docs", "n_tokens", "rate", "docs_used", "copies", "tokens_used",
        over(F.col("tokens_used"), F.col("total_tokens")).alias("actual_share"), over(F.col("tokens_used"), everything).alias("mixed_share"),
    )
