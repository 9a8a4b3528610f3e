"""Queries over tables read as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.references import iso_time
from ..session import path_kind, shared_folder
from ..sources import read_table
from ..streaming import jobs as J
from .registry import Registry

REGISTRY = Registry()


def _stream(spark: SparkSession, d: str, table: str) -> DataFrame:
    schema = read_table(spark, d, table).schema
    one = path_kind(spark, f"{d}/{table}.parquet") == "file"
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", f"{table}.parquet").parquet(d) if one else J.watched_table(spark, f"{d}/{table}.parquet", schema)


def _to_table(stream: DataFrame, name: str, keys: list[str] | None = None) -> DataFrame:
    """The stream's result as a table in the shared folder. With ``keys`` it runs in update mode: each batch writes what it changed, under its number, and the last
    change of a key counts; without, in append mode. A batch that is done again overwrites its own part."""
    out = f"{shared_folder(stream.sparkSession)}/streams/out-{name}-{uuid.uuid4().hex}"
    schema = stream.schema
    J.run_available(stream, f"{name}-{uuid.uuid4().hex}", mode="update" if keys else "append", sink=lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"))
    spark = stream.sparkSession
    if path_kind(spark, out) is None:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    if not keys:
        return read.drop("batch")
    rest = [c for c in schema.names if c not in keys]
    return read.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*keys, "_last.*").select(*schema.names)


@REGISTRY.add("stream_ledger_state", "SELECT path, status, ord FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ord DESC) AS rn FROM ledger WHERE coalesce(path, '') <> '') WHERE rn = 1")
def ledger_state(spark: SparkSession, d: str) -> DataFrame:
    return _to_table(J.running_state(_stream(spark, d, "ledger")), "ledger", ["path"])


@REGISTRY.add("stream_completed_documents", "SELECT sha FROM (SELECT source.sha256 AS sha, count(DISTINCT source.chunk.idx) AS n, any_value(source.chunk.total) AS total FROM envelope GROUP BY 1) WHERE n = total")
def completed(spark: SparkSession, d: str) -> DataFrame:
    c = _stream(spark, d, "envelope").select(F.col("source.sha256").alias("sha"), F.col("source.chunk.idx").alias("idx"), F.col("source.chunk.total").alias("total"))
    return _to_table(J.completed_documents(c), "chunks").select("sha").distinct()


@REGISTRY.add("stream_daily_activity", "SELECT CAST(date_trunc('day', CAST(ingested_at AS TIMESTAMPTZ)) AS DATE) AS day, status, count(*) AS n FROM ledger WHERE ingested_at IS NOT NULL GROUP BY 1, 2")
def activity(spark: SparkSession, d: str) -> DataFrame:
    s = _stream(spark, d, "ledger").withColumn("at", iso_time(F.col("ingested_at"))).filter("at is not null")
    return _to_table(J.windowed_activity(s, late="3650 days"), "activity", ["day", "status"]).select(F.to_date("day").alias("day"), "status", "n")
