"""Sinks: ledger lines, pages as files, versioned tables, milestones, reports, notifications. Paths may name any file system that the session's Hadoop settings know;
page files are written through Arrow's."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_kind

#: Least and greatest interval, start of a pace, and what it counts. Fixed values.
PACE = "interval_ms bigint, ok_streak int, last_429_at bigint, daily_exhausted_until bigint, ewma_latency_ms bigint, last_run_ok_count int, chunk_min_tokens int, updated_at bigint, models map<string,struct<day:string,count:int,strikes:int,exhausted_until:bigint>>"


def stamp(at: Column | None = None) -> Column:
    """An instant, now by default, as the ledger writes it: UTC, whole seconds."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if at is None else at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def append_ledger(rows: DataFrame, path: str, *, phase: str | None, now: str, schema: int = 3) -> None:
    """Adds JSON lines of a schema (3, or 2, which has no phase); durations are rounded to hundredths, an empty reason is null, nothing produced an empty list."""
    out = rows.withColumns({"schema": F.lit(schema), "ingested_at": F.lit(now)})
    if schema >= 3:
        out = out.withColumn("phase", F.lit(phase))
    if "reason" in rows.columns:
        out = out.withColumn("reason", F.nullif("reason", F.lit("")))
    if "duration_s" in rows.columns:
        out = out.withColumn("duration_s", F.round("duration_s", 2))
    none = F.array().cast("array<string>")
    out = out.withColumn("produced", F.coalesce("produced", none) if "produced" in rows.columns else none)
    out.write.mode("append").json(path)


def replace_table(df: DataFrame, path: str) -> str:
    """Writes a new version beside the old, then names it in the list of versions, and returns its path. Readers see the old version or the new, never half of one; a
    version that no list names is none."""
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    df.sparkSession.createDataFrame([(version,)], "version string").withColumn("at", F.unix_micros(F.current_timestamp())).coalesce(1).write.mode("append").json(f"{path}/versions")
    return f"{path}/{version}"


def current_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The version last named by ``replace_table``; null before the first."""
    if path_kind(spark, f"{path}/versions") is None:
        return None
    last = spark.read.schema("version string, at bigint").json(f"{path}/versions").agg(F.max_by("version", F.struct("at", "version")).alias("v")).first()["v"]
    return None if last is None else spark.read.parquet(f"{path}/{last}")


def write_pages(staged: DataFrame, root: str) -> int:
    """Materialises (rel, content) as files under ``root``, from the executors; returns how many. A file is written beside its place and moved there. The curated
    index is never written: one row that names it fails the sink before any file is made."""
    if staged.filter(F.regexp_replace("rel", "^/+|/+$", "").rlike("^(?:wiki/)?index\\.md$")).limit(1).count():
        raise ValueError("index.md is curated by hand and never written")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        n = 0
        for pdf in batches:
            for rel, content in zip(pdf["rel"], pdf["content"], strict=True):
                place = posixpath.join(base, rel.lstrip("/"))
                files.create_dir(posixpath.dirname(place), recursive=True)
                beside = f"{place}.{uuid.uuid4().hex}"
                with files.open_output_stream(beside) as f:
                    f.write(content.encode("utf-8"))
                files.move(beside, place)
                n += 1
        yield pd.DataFrame({"n": [n]})

    return staged.select("rel", "content").mapInPandas(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def promote(staged: DataFrame, root: str, ledger_rows: DataFrame, ledger: str, *, phase: str, now: str) -> int:
    """Pages first, then the ledger's lines that name them: a run that fails in between is done again, and pages are written as before."""
    n = write_pages(staged, root)
    append_ledger(ledger_rows, ledger, phase=phase, now=now)
    return n


def append_new(rows: DataFrame, log: DataFrame, key: str, path: str) -> None:
    """Appends the rows whose key the log does not have."""
    rows.join(log.select(key).distinct(), key, "left_anti").write.mode("append").json(path)


def append_text(lines: DataFrame, path: str) -> None:
    """Appends text blocks (column ``text``), a row each, to a journal."""
    lines.select("text").write.mode("append").text(path)


def notifications(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").json(path)


def run_report(results: DataFrame, path: str) -> None:
    """A JSON line for each processed file."""
    results.write.mode("append").json(path)


def set_milestone(spark: SparkSession, path: str, name: str, value: int) -> None:
    """Notes a milestone (name, value, at); the last one noted counts."""
    spark.createDataFrame([(name, value)], "name string, value bigint").withColumn("at", F.unix_micros(F.current_timestamp())).coalesce(1).write.mode("append").json(path)


def milestones(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of the milestones noted; empty before the first."""
    if path_kind(spark, path) is None:
        return spark.createDataFrame([], "name string, value bigint")
    return spark.read.schema("name string, value bigint, at bigint").json(path).groupBy("name").agg(F.max_by("value", "at").alias("value"))


def save_pace(state: DataFrame, path: str, *, now: int) -> bool:
    """Notes a pace (one row) with the time; says whether that worked, as a run goes on without."""
    try:
        state.withColumn("updated_at", F.lit(now).cast("bigint")).coalesce(1).write.mode("append").json(path)
    except Exception:  # noqa: BLE001
        return False
    return True


def load_pace(spark: SparkSession, path: str, *, start_ms: int = 4_000, least_ms: int = 1_500, most_ms: int = 300_000) -> DataFrame:
    """One row: the pace last noted, with defaults for what is missing or no number and the interval within its limits; all defaults where nothing can be read."""
    empty = spark.createDataFrame([(None,)], "line string")
    lines = spark.read.text(path).select(F.col("value").alias("line")) if path_kind(spark, path) else empty
    rows = lines.unionByName(empty).select(F.from_json("line", PACE).alias("p")).select("p.*")
    last = rows.agg(F.max_by(F.struct("*"), F.coalesce("updated_at", F.lit(-1))).alias("p")).select("p.*")
    zero = ("ok_streak", "last_429_at", "daily_exhausted_until", "ewma_latency_ms", "last_run_ok_count", "chunk_min_tokens", "updated_at")
    interval = F.greatest(F.lit(least_ms), F.least(F.lit(most_ms), F.coalesce("interval_ms", F.lit(start_ms)))).cast("bigint")
    return last.withColumns({"interval_ms": interval} | {c: F.coalesce(c, F.lit(0).cast(last.schema[c].dataType)) for c in zero} | {"models": F.coalesce("models", F.create_map().cast(last.schema["models"].dataType))})


def send_spool(files: DataFrame, messages: DataFrame, send: Callable[[dict], bool], remove: Callable[[str], None]) -> int:
    """Sends the messages taken from a spool, oldest first, and removes them, the unfit and what the spool purges; returns how many were sent. A message that could not
    be sent stays. A run takes some twenty messages, so these are what the driver holds."""
    taken = {r["path"] for r in files.filter("taken").select("path").collect()}
    sent = 0
    for m in messages.collect():
        if send(m.asDict()):
            sent += 1
        else:
            taken.discard(m["path"])
    for path in [*sorted(taken), *(r["path"] for r in files.filter("purge").select("path").toLocalIterator())]:
        remove(path)
    return sent
