"""Queries over logs of calls. The ledger stands for the log: a line is a call of its model; its status says how it went."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import pacing as P
from ..operators.references import iso_time
from ..sources import read_table
from .registry import Registry

REGISTRY = Registry()


def _calls(spark: SparkSession, d: str) -> DataFrame:
    at = F.unix_timestamp(iso_time(F.col("ingested_at")))
    return read_table(spark, d, "ledger").filter("model is not null and ingested_at is not null and path is not null").withColumn("epoch", at)


@REGISTRY.add(
    "aimd_interval",
    """WITH RECURSIVE c AS (SELECT path, status <> 'quota' AS ok, row_number() OVER (PARTITION BY path ORDER BY ord) AS i FROM ledger WHERE model IS NOT NULL AND ingested_at IS NOT NULL AND path IS NOT NULL AND status IS NOT NULL),
 r AS (SELECT path, CAST(0 AS BIGINT) AS i, CAST(4000 AS BIGINT) AS ms, 0 AS s FROM (SELECT DISTINCT path FROM c)
  UNION ALL SELECT r.path, c.i, CASE WHEN NOT c.ok THEN greatest(1500, least(300000, r.ms * 2)) WHEN r.s + 1 >= 10 THEN greatest(1500, least(300000, r.ms - 250)) ELSE r.ms END, CASE WHEN NOT c.ok OR r.s + 1 >= 10 THEN 0 ELSE r.s + 1 END FROM r JOIN c ON c.path = r.path AND c.i = r.i + 1)
SELECT path, ms AS interval_ms, s AS ok_streak, i AS calls FROM r QUALIFY row_number() OVER (PARTITION BY path ORDER BY i DESC) = 1""",
)
def aimd(spark: SparkSession, d: str) -> DataFrame:
    return P.paced(_calls(spark, d).filter("status is not null"), "path", ["ord"], F.col("status") != "quota")


@REGISTRY.add(
    "latency_ewma",
    """WITH RECURSIVE c AS (SELECT path, CAST(trunc(duration_s * 1000) AS BIGINT) AS ms, row_number() OVER (PARTITION BY path ORDER BY ord) AS i FROM ledger WHERE model IS NOT NULL AND ingested_at IS NOT NULL AND path IS NOT NULL AND duration_s IS NOT NULL),
 r AS (SELECT path, i, ms FROM c WHERE i = 1 UNION ALL SELECT r.path, c.i, CAST(floor(CAST(r.ms AS DOUBLE) * CAST(0.7 AS DOUBLE) + CAST(c.ms AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS BIGINT) FROM r JOIN c ON c.path = r.path AND c.i = r.i + 1)
SELECT path, ms AS latency_ms FROM r QUALIFY row_number() OVER (PARTITION BY path ORDER BY i DESC) = 1""",
)
def latency(spark: SparkSession, d: str) -> DataFrame:
    return P.smoothed_latency(_calls(spark, d), "path", ["ord"], (F.col("duration_s") * 1000).cast("long"))


_DAYS = """WITH c AS (SELECT model, status, CAST(epoch(CAST(ingested_at AS TIMESTAMPTZ)) AS BIGINT) AS t, reason FROM ledger WHERE model IS NOT NULL AND ingested_at IS NOT NULL AND path IS NOT NULL),
 g AS (SELECT model, strftime(to_timestamp(t) AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d') AS day, count(*) FILTER (WHERE status IN ('ok','extracted','merged')) AS ok, count(*) FILTER (WHERE status = 'quota') AS strikes, max(t) FILTER (WHERE status = 'quota') AS last, coalesce(bool_or(status = 'quota' AND coalesce(reason = 'quota_daily', false)), false) AS long FROM c GROUP BY 1, 2)
SELECT model, day, ok, strikes, CASE WHEN long OR strikes >= 3 THEN CAST(epoch((date_trunc('day', to_timestamp(last) AT TIME ZONE 'America/Los_Angeles') + INTERVAL 1 DAY) AT TIME ZONE 'America/Los_Angeles') AS BIGINT) END AS exhausted_until FROM g"""


@REGISTRY.add("model_days", _DAYS)
def model_days(spark: SparkSession, d: str) -> DataFrame:
    c = _calls(spark, d).withColumn("status", F.when(F.col("status").isin("ok", "extracted", "merged"), "ok").otherwise(F.col("status")))
    return P.model_days(c, "model", F.col("epoch"), F.col("status"), F.coalesce(F.col("reason") == "quota_daily", F.lit(False)))


_NOW = 1_750_000_000


@REGISTRY.add("model_pick", f"""WITH d AS ({_DAYS}), s AS (SELECT model, greatest(0, coalesce(max(exhausted_until), {_NOW}) - {_NOW}) AS w, min(day) AS since FROM d GROUP BY model)
SELECT arg_min(model, (since, model)) FILTER (WHERE w <= 0) AS model, min(w) AS wait_s FROM s""")
def pick(spark: SparkSession, d: str) -> DataFrame:
    """The model to call, the one longest in use first."""
    days = model_days(spark, d)
    states = days.groupBy("model").agg(F.max("exhausted_until").alias("exhausted_until"), F.struct(F.min("day"), F.col("model")).alias("prio"))
    return P.pick_model(states, F.lit(_NOW))


@REGISTRY.add("interpret_responses", """SELECT status, scope, count(*) AS n FROM (SELECT CASE WHEN status = 'quota' THEN 'quota' WHEN reason IN ('http_error', 'timeout') THEN 'http_error' WHEN reason IN ('output_truncated') THEN 'truncated' WHEN reason = 'blocked' THEN 'blocked' WHEN status = 'failed' THEN 'invalid' ELSE 'ok' END AS status,
 CASE WHEN status = 'quota' THEN CASE WHEN reason = 'quota_daily' THEN 'daily' ELSE 'minute' END END AS scope FROM ledger WHERE model IS NOT NULL AND ingested_at IS NOT NULL AND path IS NOT NULL AND status IS NOT NULL) GROUP BY ALL""")
def interpret(spark: SparkSession, d: str) -> DataFrame:
    """Responses made of the ledger's lines, classified again."""
    c = _calls(spark, d).filter("status is not null")
    quota = F.concat(F.lit('{"error":{"status":"RESOURCE_EXHAUSTED","details":[{"@type":"x.QuotaFailure","violations":[{"quotaId":"'), F.when(F.col("reason") == "quota_daily", "RequestsPerDay").otherwise("RequestsPerMinute"), F.lit('","quotaValue":"20"}]},{"@type":"x.RetryInfo","retryDelay":"34s"}]}}'))
    answer = lambda finish, text: F.lit('{"candidates":[{"finishReason":"' + finish + '","content":{"parts":[{"text":"' + text + '"}]}}]}')
    reason = F.coalesce("reason", F.lit(""))
    body = F.when(F.col("status") == "quota", quota).when(reason.isin("http_error", "timeout"), F.lit("oops")).when(reason == "output_truncated", answer("MAX_TOKENS", "x")).when(reason == "blocked", answer("SAFETY", "x")).when(F.col("status") == "failed", F.lit("not json")).otherwise(answer("STOP", "x"))
    code = F.when(F.col("status") == "quota", 429).when(reason.isin("http_error", "timeout"), 503).otherwise(200)
    return P.interpret(c.select(code.alias("code"), body.alias("body")), F.col("code"), F.col("body")).groupBy("status", "scope").agg(F.count("*").alias("n"))


@REGISTRY.add("quota_days", "SELECT DISTINCT ingested_at, strftime(CAST(ingested_at AS TIMESTAMPTZ) AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d') AS day FROM ledger WHERE ingested_at IS NOT NULL AND path IS NOT NULL AND model IS NOT NULL")
def quota_days(spark: SparkSession, d: str) -> DataFrame:
    return _calls(spark, d).select("ingested_at", D.quota_day(F.col("epoch")).alias("day")).distinct()


@REGISTRY.add("resume_schedule", f"""WITH r AS (SELECT model, coalesce(bool_or(status = 'quota'), false) AS quota, count(*) FILTER (WHERE status = 'quota') AS resume_count, 120 AS reset_s FROM ledger WHERE model IS NOT NULL AND ingested_at IS NOT NULL AND path IS NOT NULL GROUP BY model),
 c AS (SELECT *, CASE WHEN quota THEN resume_count + 1 ELSE 0 END AS chain, {_NOW} + greatest(18180, reset_s + 300) AS due FROM r)
SELECT model, quota, resume_count, reset_s, CASE WHEN quota AND chain >= 8 THEN 0 ELSE chain END AS next_count, CASE WHEN quota AND chain < 8 THEN due END AS ingest_due_at, CASE WHEN quota AND chain < 8 THEN due + 21600 WHEN NOT quota THEN {_NOW} + 21600 END AS lint_due_at FROM c""")
def resume(spark: SparkSession, d: str) -> DataFrame:
    runs = _calls(spark, d).groupBy("model").agg(F.bool_or(F.col("status") == "quota").alias("quota"), F.count_if(F.col("status") == "quota").alias("resume_count"), F.lit(120).alias("reset_s"))
    return P.next_milestones(runs, F.lit(_NOW))
