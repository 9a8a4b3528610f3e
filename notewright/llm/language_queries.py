"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..sources import read_table, spread
from . import language as L

REGISTRY = Registry()


def _segmented(spark: SparkSession, d: str) -> DataFrame:
    e = spread(read_table(spark, d, "envelope").select("source", "extraction", "note"))
    profiles = L.train_profiles(L.envelope_texts(e), F.col("text"), read_table(spark, d, "common_word"))
    return L.language_segments(L.envelope_summaries(e), F.col("summary"), profiles)


@REGISTRY.add("p2_found")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return L.unnamed_languages(_segmented(spark, d))


@REGISTRY.add("p2_labels")
def p2_labels(spark: SparkSession, d: str) -> DataFrame:
    """Each summary with its label, the language that names, its main language with a confidence, and the number of its segments."""
    s = _segmented(spark, d).withColumn("main", L.main_language(F.col("segments")))
    return s.select("sha256", "chunk_idx", "label", L.label_language(F.col("label")).alias("named"), "main.lang", "main.confidence", F.size("segments").alias("segments"))


@REGISTRY.add("p2_segments")
def p2_segments(spark: SparkSession, d: str) -> DataFrame:
    s = _segmented(spark, d).select("sha256", "chunk_idx", "summary", F.posexplode("segments").alias("segment_no", "s"))
    return s.select("sha256", "chunk_idx", "segment_no", "s.*", F.expr("substring(summary, s.start + 1, s.end - s.start)").alias("text"))


@REGISTRY.add(
    "p2_label_names",
    """
WITH l AS (SELECT DISTINCT extraction.language AS label, lower(trim(extraction.language)) AS b FROM envelope WHERE extraction.language IS NOT NULL),
n AS (SELECT label, CASE WHEN regexp_matches(b, '^[a-z]{2,3}[-_]([a-z]{2}|[0-9]{3})$') THEN regexp_extract(b, '^([a-z]{2,3})', 1) ELSE b END AS b FROM l)
SELECT label, CASE WHEN b IN ('de','deu','ger','deutsch','german') THEN 'de' WHEN b IN ('en','eng','english','anglais') THEN 'en'
  WHEN b IN ('es','spa','esp','español','espanol','castellano','spanish') THEN 'es' WHEN b IN ('fr','fra','fre','français','francais','french') THEN 'fr'
  WHEN b IN ('it','ita','italiano','italian') THEN 'it' WHEN b IN ('pt','por','português','portugues','portuguese') THEN 'pt' END AS lang FROM n""",
)
def p2_label_names(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "envelope").select(F.col("extraction.language").alias("label")).filter("label is not null").distinct().select("label", L.label_language(F.col("label")).alias("lang"))
