"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import references as R
from ..sources import read_table
from .registry import Registry

REGISTRY = Registry()

_REFS = r"""
WITH refs AS (
  SELECT DISTINCT 'link' AS tbl, sub || '/' || name AS src, CAST(pos AS INTEGER) AS pos, target,
         trim(regexp_extract(target, '^([^|#]*)', 1), ' ') AS key, CAST(seen_at AS TIMESTAMP) AS t FROM link
  UNION ALL
  SELECT DISTINCT 'envelope', source.sha256, CAST(source.chunk.idx AS INTEGER), e.slug, e.slug, CAST(CAST(extraction.extracted_at AS TIMESTAMPTZ) AS TIMESTAMP)
  FROM (SELECT source, extraction, unnest(entities) AS e FROM envelope)
), parents AS (
  SELECT 'link' AS tbl, stem AS key, CAST(created_at AS TIMESTAMP) AS c, CAST(deleted_at AS TIMESTAMP) AS d FROM page
  UNION ALL SELECT 'envelope', slug, CAST(created_at AS TIMESTAMP), CAST(deleted_at AS TIMESTAMP) FROM entity_page
), probed AS (
  SELECT r.tbl, r.src, r.pos, r.target, r.t, count(p.key) AS known,
         count(*) FILTER (WHERE p.c <= r.t) AS made, count(*) FILTER (WHERE p.c <= r.t AND (p.d IS NULL OR r.t < p.d)) AS live
  FROM refs r LEFT JOIN parents p ON p.tbl = r.tbl AND p.key = r.key GROUP BY ALL
)
"""


def _tables(spark: SparkSession, d: str) -> list[DataFrame]:
    return [read_table(spark, d, t) for t in ("link", "page", "envelope", "entity_page")]


@REGISTRY.add("p1_found", _REFS + "SELECT DISTINCT tbl, src, pos, target FROM probed WHERE live = 0")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return R.wiki_references(*_tables(spark, d)).select("tbl", "src", "pos", "target").distinct()


@REGISTRY.add(
    "p1_report",
    _REFS
    + """SELECT tbl, strftime(t, '%Y-%m') AS month, count(*) AS refs, count(*) FILTER (WHERE live = 0) AS orphans, count(*) FILTER (WHERE known = 0) AS missing,
  count(*) FILTER (WHERE known > 0 AND made = 0 AND t IS NOT NULL) AS not_yet, count(*) FILTER (WHERE made > 0 AND live = 0) AS deleted,
  count(*) FILTER (WHERE known > 0 AND t IS NULL) AS no_time FROM probed GROUP BY ALL""",
)
def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return R.orphan_report(R.wiki_references(*_tables(spark, d), keep_ok=True))
