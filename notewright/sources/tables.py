"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than there are cores, dealt out evenly, so that work in Python on a table of one small file uses all of them. Larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; one file or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
