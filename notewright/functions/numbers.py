"""Sizes, thresholds and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES_PER_TOKEN, CHUNK_FLOOR, CHUNK_DEFAULT = 2.44, 8_000, 50_000
LEAST_INTERVAL_MS, MOST_INTERVAL_MS = 1_500, 300_000


def estimated_tokens(text: Column) -> Column:
    """Tokens of a text by its bytes, where no service counts them."""
    return F.floor(F.octet_length(text) / F.lit(BYTES_PER_TOKEN)).cast("bigint") + 1


def chunk_threshold(learned: Column) -> Column:
    """The number of tokens above which a document is cut: a learned one counts only where it is lower, and not below the floor."""
    return F.when((learned > 0) & (learned < CHUNK_DEFAULT), F.greatest(F.lit(CHUNK_FLOOR), learned)).otherwise(F.lit(CHUNK_DEFAULT)).cast("bigint")


def lowered_threshold(threshold: Column, tokens: Column) -> Column:
    """The threshold after a refusal of so many tokens; it only falls."""
    return F.least(threshold, F.greatest(F.lit(CHUNK_FLOOR), F.floor(tokens * 0.8))).cast("bigint")


def chunk_sizes(tokens: Column, chars: Column, threshold: Column) -> Column:
    """struct(target_chars, overlap_chars): nine tenths of the threshold, not below the floor, in characters at the document's own rate; 8 % of that overlap."""
    target = F.floor(F.greatest(threshold * 0.9, F.lit(CHUNK_FLOOR)) * chars / F.greatest(tokens, F.lit(1)))
    return F.struct(target.cast("bigint").alias("target_chars"), F.floor(target * 0.08).cast("bigint").alias("overlap_chars"))


def clamp_interval(ms: Column) -> Column:
    return F.greatest(F.lit(LEAST_INTERVAL_MS), F.least(F.lit(MOST_INTERVAL_MS), ms)).cast("bigint")


def clamp_share(x: Column, default: float) -> Column:
    """A confidence within 0 and 1; the default where it is no number."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(x.try_cast("double"), F.lit(default))))


def next_budget(ok: Column, base: Column, quota: Column, reached: Column) -> Column:
    """The calls that a next run may make: after a quota what this one made, after a clean run up to the mark a tenth more."""
    grown = F.greatest(ok, F.greatest(base + 1, F.bround(base * 1.1, 0).cast("bigint")))
    return F.when(quota, ok).when(reached, grown).otherwise(base)


def budget(base: Column, margin: int = 3) -> Column:
    return F.when(base.isNotNull() & (base > 0), F.greatest(F.lit(1), base - margin))


def jitter(seconds: Column, seed: int = 0) -> Column:
    return F.rand(seed) * 0.3 * seconds


def backoff_seconds(attempt: Column) -> Column:
    return F.pow(F.lit(2.0), attempt)


def index_may_shrink(old_lines: Column, new_lines: Column, percent: int = 5) -> Column:
    """May an index of so many lines be replaced by one of that many?"""
    return new_lines >= old_lines - F.expr("0") - F.floor(old_lines * percent / 100) - 1
