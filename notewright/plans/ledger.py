"""Queries over the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger as L
from ..sources import read_table
from .registry import Registry

REGISTRY = Registry()
_STATE = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ord DESC) AS rn FROM ledger WHERE coalesce(path, '') <> '') WHERE rn = 1"
_FILES = "SELECT path, max(sha256) AS sha256 FROM (SELECT source.path AS path, source.sha256 AS sha256 FROM envelope) GROUP BY path"


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "ledger")


def _files(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "envelope").groupBy(F.col("source.path").alias("path")).agg(F.max("source.sha256").alias("sha256"))


@REGISTRY.add("ledger_latest_state", f"SELECT path, sha256, status, reason, attempts, ord FROM ({_STATE})")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return L.latest_state(_ledger(spark, d)).select("path", "sha256", "status", "reason", "attempts", "ord")


@REGISTRY.add("ledger_state_by_timestamp", "SELECT path, status, ord FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY coalesce(ingested_at, '') DESC, ord DESC) AS rn FROM ledger WHERE coalesce(path, '') <> '') WHERE rn = 1")
def by_time(spark: SparkSession, d: str) -> DataFrame:
    return L.latest_state_by_time(_ledger(spark, d)).select("path", "status", "ord")


@REGISTRY.add("ledger_sha_history", "SELECT path, sha256, min(ord) AS first_ord FROM ledger WHERE coalesce(path, '') <> '' AND sha256 IS NOT NULL GROUP BY ALL")
def history(spark: SparkSession, d: str) -> DataFrame:
    return L.sha_history(_ledger(spark, d))


@REGISTRY.add("ledger_produced_pages", "SELECT DISTINCT page FROM (SELECT unnest(produced) AS page FROM ledger) WHERE page IS NOT NULL")
def produced(spark: SparkSession, d: str) -> DataFrame:
    return L.produced_pages(_ledger(spark, d))


@REGISTRY.add(
    "ledger_eligible",
    f"""SELECT f.path, CASE WHEN s.path IS NULL OR f.sha256 IS DISTINCT FROM s.sha256 THEN true WHEN s.status IN ('ok','merged','extracted','skipped') THEN false WHEN s.status = 'quota' THEN true
 WHEN s.status = 'failed' AND s.reason = 'oversized' THEN false WHEN s.status = 'failed' THEN coalesce(s.attempts, 0) < 3 ELSE true END AS eligible,
 CASE WHEN s.path IS NULL OR f.sha256 IS DISTINCT FROM s.sha256 THEN 0 ELSE coalesce(s.attempts, 0) END AS attempts FROM ({_FILES}) f LEFT JOIN ({_STATE}) s USING (path)""",
)
def eligible(spark: SparkSession, d: str) -> DataFrame:
    return L.eligibility(_files(spark, d), L.latest_state(_ledger(spark, d)))


@REGISTRY.add(
    "ledger_eligible_v2",
    f"""SELECT f.path, CASE WHEN s.path IS NULL OR f.sha256 IS DISTINCT FROM s.sha256 THEN true WHEN s.status IN ('ok','skipped') THEN false WHEN s.status = 'failed' THEN coalesce(s.attempts, 0) < 3 ELSE true END AS eligible
 FROM ({_FILES}) f LEFT JOIN ({_STATE}) s USING (path)""",
)
def eligible_v2(spark: SparkSession, d: str) -> DataFrame:
    return L.eligibility_v2(_files(spark, d), L.latest_state(_ledger(spark, d)))


@REGISTRY.add("ledger_status_counts", f"SELECT count(*) AS total, count(*) FILTER (WHERE status IN ('ok','merged','extracted')) AS done, count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'quota') AS quota FROM ({_STATE})")
def counts(spark: SparkSession, d: str) -> DataFrame:
    return L.status_counts(L.latest_state(_ledger(spark, d)))


@REGISTRY.add("ledger_reason_histogram", f"SELECT coalesce(reason, '?') AS reason, count(*) AS n FROM ({_STATE}) WHERE status IS DISTINCT FROM 'ok' GROUP BY 1")
def reasons(spark: SparkSession, d: str) -> DataFrame:
    return L.reason_histogram(L.latest_state(_ledger(spark, d)))


@REGISTRY.add("ledger_summary_by_status", f"SELECT coalesce(status, '?') AS status, count(*) AS n FROM ({_STATE}) GROUP BY 1")
def by_status(spark: SparkSession, d: str) -> DataFrame:
    return L.summary_by_status(L.latest_state(_ledger(spark, d)))


@REGISTRY.add("ledger_refusals", "SELECT path, sha256, count(*) FILTER (WHERE reason = 'tpm_reject') AS rejects, count(*) FILTER (WHERE reason = 'tpm_reject') >= 2 AS oversized FROM ledger WHERE coalesce(path, '') <> '' AND sha256 IS NOT NULL GROUP BY path, sha256 HAVING count(*) FILTER (WHERE reason = 'tpm_reject') > 0")
def refusals(spark: SparkSession, d: str) -> DataFrame:
    return L.refusals(_ledger(spark, d))


@REGISTRY.add("ledger_attempts", "SELECT path, sha256, coalesce(attempts, 0) AS attempts FROM (SELECT *, row_number() OVER (PARTITION BY path, sha256 ORDER BY coalesce(ingested_at, '') DESC, (attempts IS NULL), ord DESC) AS rn FROM ledger WHERE coalesce(path, '') <> '' AND sha256 IS NOT NULL) WHERE rn = 1")
def attempts(spark: SparkSession, d: str) -> DataFrame:
    return L.attempts(_ledger(spark, d))


@REGISTRY.add("ledger_not_done", f"SELECT path, status, reason, attempts FROM ({_STATE}) WHERE status IS DISTINCT FROM 'ok'")
def not_done(spark: SparkSession, d: str) -> DataFrame:
    return L.not_done(L.latest_state(_ledger(spark, d)))


@REGISTRY.add("ledger_retry_rows", f"SELECT path, sha256, size, mtime, 'failed' AS status, 'manual_retry' AS reason, 0 AS attempts FROM ({_STATE}) WHERE reason = 'timeout' AND status IS DISTINCT FROM 'ok'")
def retry(spark: SparkSession, d: str) -> DataFrame:
    return L.retry_rows(L.latest_state(_ledger(spark, d)), F.col("reason") == "timeout")


@REGISTRY.add("ledger_migrate_v1", f"SELECT DISTINCT regexp_replace(l.path, '^/home/', '/srv/') AS path, CASE WHEN f.path IS NULL THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN f.path IS NULL THEN 'source_missing_at_migration' ELSE 'migrated_v1' END AS reason FROM ledger l LEFT JOIN ({_FILES}) f ON f.path = regexp_replace(l.path, '^/home/', '/srv/') WHERE schema_version = 1")
def migrate(spark: SparkSession, d: str) -> DataFrame:
    return L.migrate_v1(_ledger(spark, d), _files(spark, d))


@REGISTRY.add("ledger_daily_activity", "SELECT strftime(CAST(ingested_at AS TIMESTAMPTZ), '%Y-%m-%d') AS day, model, count(*) AS lines, count(*) FILTER (WHERE status IN ('ok','merged','extracted','skipped')) AS succeeded, round(sum(duration_s), 3) AS seconds FROM ledger WHERE ingested_at IS NOT NULL GROUP BY 1, 2")
def daily(spark: SparkSession, d: str) -> DataFrame:
    return L.daily_activity(_ledger(spark, d))
