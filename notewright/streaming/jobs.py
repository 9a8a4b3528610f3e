"""Streaming counterparts of the incremental and stateful parts. Each takes a streaming DataFrame and returns one, or starts a query with a checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as X
from ..session import shared_folder
from ..sources.sinks import current_table, replace_table

CHUNKS = "sha string, chunks int, total int, first_idx int, last_idx int"


def watched_table(spark: SparkSession, folder: str, schema, *, files: int = 20) -> DataFrame:  # noqa: ANN001
    """The Parquet files of a folder as they come, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("latestFirst", "false").parquet(folder)


#: How long an incomplete document waits, where its job runs on by processing time.
WAIT_MS = 30 * 24 * 3600 * 1000


def _complete(wait: int | None):  # noqa: ANN202
    return lambda key, batches, state: _collect(wait, key, batches, state)


def _collect(wait: int | None, key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    seen: set[int] = set(state.get[0]) if state.exists else set()
    if state.hasTimedOut:
        state.remove()
        return
    total = state.get[1] if state.exists else None
    for b in batches:
        seen |= set(b["idx"].dropna().astype(int))
        if total is None and b["total"].notna().any():
            total = int(b["total"].dropna().iloc[0])
    if total is not None and len(seen) >= total:
        state.remove()
        yield pd.DataFrame({"sha": [key[0]], "chunks": [len(seen)], "total": [total], "first_idx": [min(seen)], "last_idx": [max(seen)]})
    else:
        state.update((sorted(seen), total))
        if wait:
            state.setTimeoutDuration(wait)


def completed_documents(chunks: DataFrame, *, wait_ms: int | None = None) -> DataFrame:
    """(sha, chunks, total, first_idx, last_idx): a document when its last missing chunk (sha, idx, total) arrives. Chunks that come twice count once. With ``wait_ms``
    (``WAIT_MS``, say) the state of an incomplete document is given up after that time without a chunk; leave it out for runs that end when all is read, as
    Spark goes on as long as a timeout may come."""
    timeout = GroupStateTimeout.ProcessingTimeTimeout if wait_ms else GroupStateTimeout.NoTimeout
    return chunks.groupBy("sha").applyInPandasWithState(_complete(wait_ms), CHUNKS, "seen array<int>, total int", "append", timeout)


def windowed_activity(ledger: DataFrame, *, late: str = "30 days", width: str = "1 day") -> DataFrame:
    """(day, status, n) by event time, rows later than ``late`` left out."""
    return ledger.withWatermark("at", late).groupBy(F.window("at", width).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "status", "n")


def running_state(ledger: DataFrame) -> DataFrame:
    """The last line of each path so far; run it in update or complete mode."""
    return ledger.filter("coalesce(path, '') <> ''").groupBy("path").agg(F.max_by("status", "ord").alias("status"), F.max("ord").alias("ord"))


def watched_messages(spark: SparkSession, folder: str, *, files: int = 20) -> DataFrame:
    """(emoji, text, persist, attach, path): the JSON messages of a spool folder as they come, one a file, oldest first, at most ``files`` a batch; a file that is no JSON has
    no text."""
    s = spark.readStream.format("text").schema("value string").option("wholetext", "true").option("maxFilesPerTrigger", files).option("latestFirst", "false").option("pathGlobFilter", "*.json").load(folder)
    return s.select(F.from_json("value", "emoji string, text string, persist int, attach string").alias("m"), F.col("_metadata.file_path").alias("path")).select("m.*", "path")


def upserted(path: str, merge: Callable[[DataFrame, DataFrame], DataFrame], make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A sink that keeps a versioned table of state across batches: what ``make`` makes of a batch is merged into the version last named, by ``merge(old, new)``, and
    named in turn. ``_batch`` is the last batch that the table holds; one that is done again changes nothing."""

    def sink(batch: DataFrame, n: int) -> None:
        new, old = make(batch), current_table(batch.sparkSession, path)
        if old is not None:
            seen = old.agg(F.max("_batch").alias("b")).first()["b"]
            if seen is not None and seen >= n:
                return
            new = merge(old.drop("_batch"), new)
        replace_table(new.withColumn("_batch", F.lit(n).cast("bigint")), path)

    return sink


def drained(messages: DataFrame) -> DataFrame:
    """Notifications (emoji, text, persist, attach) fit to send: of a fair size, with text, secrets hidden, cut to 3,600 bytes, and only audit reports attached."""
    m = messages.filter((F.octet_length(F.coalesce("text", F.lit(""))) <= 65_536) & (F.trim(F.coalesce("text", F.lit(""))) != ""))
    report = F.when(F.col("attach").rlike(r"^/var/lib/[a-z-]+/report-[^/]*\.md$"), F.col("attach"))
    return m.select(F.concat_ws(" ", X.sign(F.col("emoji")), X.first_bytes(X.redact(F.col("text")), 3_600)).alias("message"), F.coalesce("persist", F.lit(0)).alias("persist"), report.alias("attach"))


def run_available(stream: DataFrame, name: str, *, mode: str = "append", sink: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Runs a stream over all that is there, then stops. With ``sink`` each micro-batch goes to it with its number, which makes a repeated batch known; else to a memory table."""
    w = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{shared_folder(stream.sparkSession)}/streams/{name}")
    w = w.foreachBatch(sink) if sink else w.format("memory").queryName(name)
    q = w.start()
    q.awaitTermination()
    return q
