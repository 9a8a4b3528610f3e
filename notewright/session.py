"""Session settings, the shared folder, and the cutting of lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Settings the engine relies on; a cluster may override all of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("notewright")
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.config("spark.sql.shuffle.partitions", partitions).config("spark.driver.memory", memory).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset (one machine only) a temporary folder is made once."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="notewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths of the tables that this process has written, oldest first.
_WRITTEN: list[str] = []


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a table written to the shared folder: lineage is cut, the rows are fixed, and the loss of an executor costs no recomputation. The tables
    stay until ``clear_written`` or the end of a ``scratch`` block, as results are lazy and may read them."""
    path = f"{shared_folder(df.sparkSession)}/notewright/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_kind(spark: SparkSession, path: str) -> str | None:
    """'file', 'folder' or null for what is not there, by the file system that the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return None if not fs.exists(p) else "file" if fs.getFileStatus(p).isFile() else "folder"


def clear_written(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables that ``written`` made, from the ``since``-th on; returns how many. Call it when results that read them are stored."""
    gone = _WRITTEN[since:]
    del _WRITTEN[since:]
    for path in gone:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(gone)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """The tables that ``written`` makes inside the block are deleted at its end."""
    since = len(_WRITTEN)
    try:
        yield
    finally:
        clear_written(spark, since)


def in_order(df: DataFrame, order: list[Column | str], into: str = "place") -> DataFrame:
    """``df`` with each row's place, from 1, in the order of all rows: sorted by ranges, counted by partition, never in one task. It is written once."""
    sorted_ = written(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("_id", 33)
    n = sorted_.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row a partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = n.select("_part", before.alias("_start"))
    j = sorted_.withColumn("_part", part).join(starts, "_part")
    return j.withColumn(into, F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_start", "_id")
