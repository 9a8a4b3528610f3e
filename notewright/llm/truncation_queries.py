"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.registry import Registry
from ..sources import read_table, spread
from . import truncation as T

REGISTRY = Registry()


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    e = spread(read_table(spark, d, "envelope").select("source", "note", "entities"))
    return T.truncation_evidence(T.envelope_values(e), T.envelope_corpus(e))


@REGISTRY.add("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _evidence(spark, d).filter("cut is not null").select("sha256", "chunk_idx", "field").distinct()


@REGISTRY.add("p5_rates")
def p5_rates(spark: SparkSession, d: str) -> DataFrame:
    return T.truncation_rates(_evidence(spark, d))


@REGISTRY.add(
    "p5_spikes",
    """
WITH v AS (
  SELECT DISTINCT split_part(source.path, '/', 1) AS area, f.field, f.value FROM envelope,
    unnest([{'field': 'summary', 'value': note.summary}, {'field': 'title', 'value': note.title}]) AS t(f) WHERE trim(f.value) <> ''
), c AS (
  SELECT area, field, u.unit, u.length, count(DISTINCT value) AS n FROM v,
    unnest([{'unit': 'chars', 'length': CAST(length(value) AS INTEGER)}, {'unit': 'bytes', 'length': CAST(strlen(value) AS INTEGER)}]) AS t(u) GROUP BY ALL
), w AS (
  SELECT *, (sum(n) OVER (PARTITION BY area, field, unit ORDER BY length RANGE BETWEEN 20 PRECEDING AND 20 FOLLOWING) - n) / 40.0 AS usual,
    coalesce(sum(n) OVER (PARTITION BY area, field, unit ORDER BY length ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) / sum(n) OVER (PARTITION BY area, field, unit) AS longer FROM c
)
SELECT area, field, unit, length, n, CAST(usual AS DOUBLE) AS usual, CAST(longer AS DOUBLE) AS longer FROM w WHERE n >= 4 AND n >= 6 * usual AND longer <= 0.75""",
)
def p5_spikes(spark: SparkSession, d: str) -> DataFrame:
    return T.length_spikes(T.envelope_values(read_table(spark, d, "envelope")))
