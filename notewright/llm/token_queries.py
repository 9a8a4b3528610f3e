"""Queries of problems 6 and 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..session import written
from ..sources import read_table, spread
from . import mixing as M
from . import packing as P

REGISTRY = Registry()


@REGISTRY.add("p6_places")
def p6_places(spark: SparkSession, d: str) -> DataFrame:
    specs = [(r["spec"], r["capacity_tokens"]) for r in read_table(spark, d, "pack_spec").collect()]  # the fixed table of sizes
    return P.pack(spread(read_table(spark, d, "documents").select("doc_id", "text")), F.col("text"), F.col("doc_id"), specs)


@REGISTRY.add("p6_fill")
def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return P.fill(p6_places(spark, d), read_table(spark, d, "pack_spec"))


def _mixture(spark: SparkSession, d: str) -> DataFrame:
    return M.mix(spread(read_table(spark, d, "documents").select("doc_id", "source", "text")), F.col("text"), F.col("doc_id"), F.col("source"), read_table(spark, d, "mix_target"))


@REGISTRY.add("p7_mixture")
def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)


@REGISTRY.add("p7_shares")
def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return M.shares_reached(written(_mixture(spark, d), "mixture"), read_table(spark, d, "mix_target"))
