"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..sources import read_table, spread
from . import quality as Q

REGISTRY = Registry()


def _quality(spark: SparkSession, d: str, keep: list[str]) -> DataFrame:
    return Q.text_quality(spread(read_table(spark, d, "documents").select("text", *keep)), F.col("text"), read_table(spark, d, "common_word"), keep)


@REGISTRY.add("p8_found")
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d, ["doc_id"]).filter("kind <> 'prose'").select("doc_id", "kind")


@REGISTRY.add("p8_stats")
def p8_stats(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d, ["doc_id", "source", "lang"])


@REGISTRY.add("p8_kinds_by_source")
def p8_kinds_by_source(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d, ["source"]).groupBy("source", "kind").agg(F.count("*").alias("n"), F.round(F.avg("mean_word_length"), 6).alias("mean_word_length"), F.round(F.avg("common_share"), 6).alias("common_share"))
