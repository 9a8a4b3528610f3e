"""Decisions about calls to a language model, as folds over logs of calls and as projections of responses. Nothing here calls anything."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N

START_MS, STEP_MS, STREAK, FACTOR = 4_000, 250, 10, 2
LONG_DELAY_S, STRIKES = 3_600, 3


def _folded(calls: DataFrame, key: str, order: list[str], value: Column, start, step, out: str):  # noqa: ANN001, ANN202
    """(key, …): a state folded over the values of each key in order. Rows are sorted within partitions and read in batches, so a key may have any number."""
    src = calls.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], value.alias("_v"))
    src = src.repartition("_k").sortWithinPartitions("_k", *[f"_o{i}" for i in range(len(order))]).select("_k", "_v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, state, done = none, start, []
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != now:
                    if now is not none:
                        done.append((now, *state))
                    now, state = k, start
                state = step(state, v)
            if done:
                yield _rows(b.schema.field(0).type, done)
                done = []
        if now is not none:
            yield _rows(pa.string(), [(now, *state)])

    return src.mapInArrow(run, f"{key} string, {out}")


def _rows(kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:]]], [str(i) for i in range(len(cols))])


def _pace(state: tuple[int, int, int], ok: bool) -> tuple[int, int, int]:
    ms, streak, n = state
    clamp = lambda x: max(N.LEAST_INTERVAL_MS, min(N.MOST_INTERVAL_MS, x))
    if not ok:
        return clamp(ms * FACTOR), 0, n + 1
    return (clamp(ms - STEP_MS), 0, n + 1) if streak + 1 >= STREAK else (ms, streak + 1, n + 1)


def paced(calls: DataFrame, key: str, order: list[str], ok: Column) -> DataFrame:
    """(key, interval_ms, ok_streak, calls): the interval after all calls of a pacer in order: ten good ones in a row shorten it, a refusal doubles it. The key is a
    pacer: a constant where all calls share one."""
    out = _folded(calls, key, order, ok, (START_MS, 0, 0), _pace, "interval_ms bigint, ok_streak bigint, calls bigint")
    return out.withColumn("ok_streak", F.col("ok_streak").cast("int"))


def _smooth(state: tuple[int | None], ms: int) -> tuple[int]:
    return (ms if state[0] is None else math.floor(state[0] * 0.7 + ms * 0.3),)


def smoothed_latency(calls: DataFrame, key: str, order: list[str], ms: Column) -> DataFrame:
    """(key, latency_ms): seven tenths of the value so far and three of the new one, whole milliseconds at each step; the first is taken as it is."""
    return _folded(calls.filter(ms.isNotNull()), key, order, ms.cast("long"), (None,), _smooth, "latency_ms bigint")


def quota_scope(quota_id: Column, retry_s: Column) -> Column:
    """'daily' or 'minute', by the name of the quota, else by the delay."""
    q = F.lower(F.coalesce(quota_id, F.lit("")))
    return F.when(F.contains(q, F.lit("perday")), "daily").when(F.contains(q, F.lit("perminute")), "minute").when(retry_s > LONG_DELAY_S, "daily").otherwise("minute")


_ERROR = "error STRUCT<status:STRING, details:ARRAY<STRUCT<`@type`:STRING, retryDelay:STRING, violations:ARRAY<STRUCT<quotaId:STRING,quotaValue:STRING>>>>>"
_SUCCESS = "usageMetadata MAP<STRING,BIGINT>, promptFeedback STRUCT<blockReason:STRING>, candidates ARRAY<STRUCT<finishReason:STRING, content:STRUCT<parts:ARRAY<STRUCT<text:STRING>>>>>"
BLOCKED = ("SAFETY", "RECITATION", "BLOCKLIST", "PROHIBITED_CONTENT", "SPII")


def interpret(df: DataFrame, code: Column, body: Column) -> DataFrame:
    """``df`` with status, retry_s, quota_id, quota_value, scope and text of a response: the first that holds of quota, server error, other error, no JSON, blocked, no answer, cut, ok."""
    raw = F.coalesce(body, F.lit(""))
    d = df.withColumns({"_b": F.from_json(raw, f"{_ERROR}, {_SUCCESS}"), "_raw": raw, "_code": code})
    details = F.coalesce(F.col("_b.error.details"), F.array().cast("array<struct<`@type`:string,retryDelay:string,violations:array<struct<quotaId:string,quotaValue:string>>>>"))
    retry = F.try_element_at(F.filter(details, lambda x: F.endswith(F.coalesce(x["@type"], F.lit("")), F.lit("RetryInfo"))), F.lit(1))["retryDelay"]
    violation = F.try_element_at(F.filter(F.flatten(F.transform(details, lambda x: F.coalesce(x.violations, F.array().cast("array<struct<quotaId:string,quotaValue:string>>")))), lambda v: v.quotaId.isNotNull()), F.lit(1))
    first = F.try_element_at(F.col("_b.candidates"), F.lit(1))
    text = F.array_join(F.transform(F.coalesce(first.content.parts, F.array().cast("array<struct<text:string>>")), lambda p: F.coalesce(p.text, F.lit(""))), "")
    quota = (F.col("_code") == 429) | (F.coalesce(F.col("_b.error.status"), F.lit("")) == "RESOURCE_EXHAUSTED") | F.contains("_raw", F.lit("RESOURCE_EXHAUSTED"))
    status = F.when(quota, "quota").when(F.col("_code") >= 500, "http_error").when(F.col("_code") != 200, "http_error").when(F.try_parse_json("_raw").isNull(), "invalid").when(F.col("_b.promptFeedback.blockReason").isNotNull(), "blocked")
    status = status.when(first.isNull(), "invalid").when(first.finishReason == "MAX_TOKENS", "truncated").when(first.finishReason.isin(*BLOCKED), "blocked").when(F.trim(text) == "", "invalid").otherwise("ok")
    seconds = D.duration_seconds(retry)
    return d.withColumns({"status": status, "retry_s": seconds, "quota_id": violation.quotaId, "quota_value": violation.quotaValue.try_cast("int"), "scope": F.when(quota, quota_scope(violation.quotaId, seconds)), "answer": F.when(status == "ok", text)}).drop("_b", "_raw", "_code")


#: What a status is called in the ledger. Fixed values.
REASONS = {"truncated": "output_truncated", "blocked": "blocked", "invalid": "api_invalid", "timeout": "timeout", "http_error": "http_error"}


def failure_reason(status: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv]), status)


def thinking_step_down(level: Column) -> Column:
    """The next milder thinking level to ask for, null after the last."""
    return F.when(level == "minimal", "low").when(level == "low", "medium")


def cascade(spec: Column) -> Column:
    """Models of a comma list, each once, without moving aliases."""
    return F.array_distinct(F.filter(F.transform(F.split(spec, ","), lambda m: F.trim(m)), lambda m: (m != "") & ~F.endswith(m, F.lit("-latest"))))


def model_days(calls: DataFrame, model: str, epoch: Column, status: Column, long_delay: Column, reset_s: Column | None = None) -> DataFrame:
    """(model, day, ok, strikes, exhausted_until): calls of a model by quota day; three refusals, or one with a long delay, close it for as long as the last refusal
    says (``reset_s``), until the next midnight of the quota zone at the latest."""
    day = D.quota_day(epoch)
    g = calls.groupBy(F.col(model).alias("model"), day.alias("day")).agg(F.count_if(status == "ok").alias("ok"), F.count_if(status == "quota").alias("strikes"), F.max(F.when(status == "quota", epoch)).alias("last"), F.max_by(F.lit(None).cast("double") if reset_s is None else reset_s, F.when(status == "quota", epoch)).alias("reset"), F.coalesce(F.bool_or((status == "quota") & long_delay), F.lit(False)).alias("long"))
    return g.select("model", "day", "ok", "strikes", F.when(F.col("long") | (F.col("strikes") >= STRIKES), F.least(D.next_quota_midnight(F.col("last")), F.when(F.col("reset").isNotNull(), F.floor(F.col("last") + F.greatest(F.col("reset"), F.lit(0.0))).cast("long")))).alias("exhausted_until"))


def pick_model(states: DataFrame, now: Column) -> DataFrame:
    """(model, wait_s): the first open model by ``prio``; without one null and the least wait. ``states``: model, prio, exhausted_until."""
    wait = F.greatest(F.lit(0), F.coalesce("exhausted_until", now) - now)
    return states.withColumn("w", wait).agg(F.min_by("model", F.when(F.col("w") <= 0, F.col("prio"))).alias("model"), F.min("w").alias("wait_s"))


def next_milestones(state: DataFrame, now: Column, *, delay: int = 18_180, lint_delay: int = 21_600, most: int = 8) -> DataFrame:
    """After a run (quota, resume_count, reset_s): when to go on and when to audit; a chain of ``most`` resumptions ends."""
    chain = F.when(F.col("quota"), F.col("resume_count") + 1).otherwise(0)
    due = now + F.greatest(F.lit(delay), F.coalesce("reset_s", F.lit(0)) + 300)
    go = F.col("quota") & (chain < most)
    return state.withColumns({"next_count": F.when(F.col("quota") & (chain >= most), 0).otherwise(chain), "ingest_due_at": F.when(go, due), "lint_due_at": F.when(go, due + lint_delay).when(~F.col("quota"), now + lint_delay)})


def poll_action(milestones: DataFrame, now: Column) -> DataFrame:
    """One row: 'resume' if that is due, else 'lint' if that is, else 'wait'."""
    at = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    return milestones.agg(F.when(at("ingest-due-at") <= now, "resume").when(at("ingest-due-at").isNull() & (at("lint-due-at") <= now), "lint").otherwise("wait").alias("action"))


def open_models(states: DataFrame, now: Column) -> DataFrame:
    """The models (model, exhausted_until, …) that are not closed at an instant."""
    return states.filter(F.coalesce("exhausted_until", now) <= now)


def calls_of_day(days: DataFrame, day: Column) -> DataFrame:
    """One row: calls by model on a quota day, as a map; there are a few models."""
    return days.filter(F.col("day") == day).agg(F.map_from_entries(F.collect_list(F.struct("model", "ok"))).alias("counts"))


def cascaded(attempts: DataFrame) -> DataFrame:
    """(request, model, status): of the attempts (request, prio, model, status, scope) at each request, the one that counts: the first, by ``prio``, that was not refused
    for the day; the last one where all were. Only a refusal for the day goes on to the next model."""
    daily = (F.col("status") == "quota") & (F.coalesce("scope", F.lit("")) == "daily")
    one = F.struct("model", "status")
    g = attempts.groupBy("request").agg(F.coalesce(F.min_by(one, F.when(~daily, F.col("prio"))), F.max_by(one, "prio")).alias("o"))
    return g.select("request", "o.*")


def learned_threshold(start: Column, tokens: Column) -> Column:
    """An aggregate: the threshold after all requests of so many tokens that were too large. Each lowers it to four fifths of its tokens, never below the floor and never
    up again, so their order does not matter."""
    return F.least(F.max(start), F.coalesce(F.min(F.greatest(F.lit(N.CHUNK_FLOOR), F.floor(tokens * 0.8))), F.max(start))).cast("bigint")


def weekly_run(milestones: DataFrame, now: Column) -> DataFrame:
    """One row: may a weekly run start? Not while a resumption is still to come."""
    due = F.max(F.when(F.col("name") == "ingest-due-at", F.col("value")))
    return milestones.agg((F.coalesce(due, F.lit(0)) <= now).alias("start"))


def within_budget(calls: DataFrame, order: list[str], budget: int) -> DataFrame:
    """The calls that a run may make: the first ``budget`` in order; the rest waits, as a run stops by itself before a quota does it."""
    return calls.orderBy(*order).limit(max(0, budget))
