"""The append-only ledger: its state, what is to be done, and its figures.

Rows carry ``ord``, the order of the lines. Rows without a path are skipped. Reading is one aggregation by path with partial sums before the shuffle, so a path that
holds a third of all rows costs no more than its last row by task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .references import iso_time

MAX_ATTEMPTS = 3
DONE = ("ok", "merged", "extracted", "skipped")


def _rows(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.coalesce(F.col("path"), F.lit("")) != "")


def latest_state(ledger: DataFrame) -> DataFrame:
    """The last line of each path."""
    last = _rows(ledger).groupBy("path").agg(F.max_by(F.struct(*[c for c in ledger.columns if c != "path"]), "ord").alias("r"))
    return last.select("path", "r.*")


def latest_state_by_time(ledger: DataFrame) -> DataFrame:
    """The row of each path with the latest ``ingested_at`` as text, of equal ones the later line."""
    at = F.struct(F.coalesce(F.col("ingested_at"), F.lit("")), F.col("ord"))
    last = _rows(ledger).groupBy("path").agg(F.max_by(F.struct(*[c for c in ledger.columns if c != "path"]), at).alias("r"))
    return last.select("path", "r.*")


def sha_history(ledger: DataFrame) -> DataFrame:
    """(path, sha256, first_ord): each content of a path with the line that named it first."""
    return _rows(ledger).filter("sha256 is not null").groupBy("path", "sha256").agg(F.min("ord").alias("first_ord"))


def produced_pages(ledger: DataFrame) -> DataFrame:
    """(page): all pages that any line says were produced."""
    return ledger.select(F.explode("produced").alias("page")).filter("page is not null").distinct()


def eligibility(files: DataFrame, state: DataFrame, *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(path, eligible, attempts): is a file (path, sha256) to be extracted? Unknown or changed files are, with their attempts anew."""
    s = state.select("path", F.col("sha256").alias("known_sha"), "status", "reason", F.col("attempts").alias("made"), F.lit(True).alias("known"))
    j = files.select("path", "sha256").join(s, "path", "left")
    changed = ~F.col("sha256").eqNullSafe(F.col("known_sha"))
    made = F.coalesce("made", F.lit(0))
    ok = F.when(F.col("known").isNull() | changed, True).when(F.col("status").isin(*DONE), False).when(F.col("status") == "quota", True).when((F.col("status") == "failed") & (F.col("reason") == "oversized"), False).when(F.col("status") == "failed", made < max_attempts).otherwise(True)
    return j.select("path", ok.alias("eligible"), F.when(F.col("known").isNull() | changed, 0).otherwise(made).alias("attempts"))


def eligibility_v2(files: DataFrame, state: DataFrame, *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """As ``eligibility`` by the older rule: only ok and skipped are done, and oversized files are tried like others."""
    s = state.select("path", F.col("sha256").alias("known_sha"), "status", F.col("attempts").alias("made"), F.lit(True).alias("known"))
    j = files.select("path", "sha256").join(s, "path", "left")
    ok = F.when(F.col("known").isNull() | ~F.col("sha256").eqNullSafe(F.col("known_sha")), True).when(F.col("status").isin("ok", "skipped"), False).when(F.col("status") == "failed", F.coalesce("made", F.lit(0)) < max_attempts).otherwise(True)
    return j.select("path", ok.alias("eligible"))


def status_counts(state: DataFrame) -> DataFrame:
    """One row: paths, and how many are ok, skipped, failed, waiting for a quota."""
    n = lambda c, name: F.count_if(c).alias(name)
    s = F.col("status")
    return state.agg(F.count("*").alias("total"), n(s.isin("ok", "merged", "extracted"), "done"), n(s == "skipped", "skipped"), n(s == "failed", "failed"), n(s == "quota", "quota"))


def reason_histogram(state: DataFrame) -> DataFrame:
    """Reasons of the paths that are not ok; a missing one is '?'."""
    return state.filter(~F.col("status").eqNullSafe(F.lit("ok"))).groupBy(F.coalesce("reason", F.lit("?")).alias("reason")).agg(F.count("*").alias("n"))


def refusals(ledger: DataFrame, *, most: int = 2) -> DataFrame:
    """(path, sha256, rejects, oversized): contents refused as too large for a request; from the ``most``-th on they are given up."""
    n = _rows(ledger).filter("sha256 is not null").groupBy("path", "sha256").agg(F.count_if(F.col("reason") == "tpm_reject").alias("rejects"))
    return n.filter("rejects > 0").withColumn("oversized", F.col("rejects") >= most)


def attempts(ledger: DataFrame) -> DataFrame:
    """(path, sha256, attempts) of the latest line by time of each content."""
    at = F.struct(F.coalesce(F.col("ingested_at"), F.lit("")), F.col("ord"))
    return _rows(ledger).filter("sha256 is not null").groupBy("path", "sha256").agg(F.coalesce(F.max_by("attempts", at), F.lit(0)).alias("attempts"))


def not_done(state: DataFrame) -> DataFrame:
    return state.filter(~F.col("status").eqNullSafe(F.lit("ok"))).select("path", "status", "reason", "attempts")


def retry_rows(state: DataFrame, which: Column) -> DataFrame:
    """Rows to append so that the paths that ``which`` holds for and that are not ok are tried anew."""
    return state.filter(which & ~F.col("status").eqNullSafe(F.lit("ok"))).select("path", "sha256", "size", "mtime", F.lit("failed").alias("status"), F.lit("manual_retry").alias("reason"), F.lit(0).alias("attempts"))


def migrate_v1(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Paths of schema 1 as rows of schema 2: ok where the file is there, else skipped."""
    old = ledger.filter("schema_version = 1").select(F.regexp_replace("path", "^/home/", "/srv/").alias("path")).distinct()
    j = old.join(files.select("path", F.lit(True).alias("there")).distinct(), "path", "left")
    return j.select("path", F.when(F.col("there"), "ok").otherwise("skipped").alias("status"), F.when(F.col("there"), "migrated_v1").otherwise("source_missing_at_migration").alias("reason"))


def summary_by_status(state: DataFrame) -> DataFrame:
    return state.groupBy(F.coalesce("status", F.lit("?")).alias("status")).agg(F.count("*").alias("n"))


def daily_activity(ledger: DataFrame) -> DataFrame:
    """Lines, calls that succeeded and seconds by day and model."""
    day = F.date_format(iso_time(F.col("ingested_at")), "yyyy-MM-dd")
    return ledger.filter("ingested_at is not null").groupBy(day.alias("day"), "model").agg(F.count("*").alias("lines"), F.count_if(F.col("status").isin(*DONE)).alias("succeeded"), F.round(F.sum("duration_s"), 3).alias("seconds"))
