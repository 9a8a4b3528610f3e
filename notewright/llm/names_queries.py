"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..sources import read_table
from . import names as N

REGISTRY = Registry()


def _linked(spark: SparkSession, d: str) -> DataFrame:
    names = N.typed_names(read_table(spark, d, "envelope"))
    return N.link_names(names, N.known_first_names(names))


@REGISTRY.add("p4_found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return N.slug_pairs(_linked(spark, d))


@REGISTRY.add("p4_clusters")
def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Each slug with the smallest slug that stands for the same, and the number of slugs that do."""
    linked = _linked(spark, d)
    heads = linked.groupBy("component").agg(F.min("slug").alias("entity"), F.count("*").alias("slugs"))
    return linked.join(heads, "component").select("slug", "entity", "slugs")
