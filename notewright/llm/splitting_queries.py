"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..sources import read_table, spread
from . import splitting as S

REGISTRY = Registry()


def _limits(spark: SparkSession, d: str) -> dict[str, tuple[int, int]]:
    return {r["item_kind"]: (r["max_size"], r["overlap"]) for r in read_table(spark, d, "split_spec").collect()}  # the fixed table of limits


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    return S.split_oversized(S.section_texts(spread(read_table(spark, d, "envelope").select("source", "note"))), ["sha256", "chunk_idx", "section_no"], "text", *_limits(spark, d)["section"])


@REGISTRY.add(
    "p3_found",
    """
SELECT DISTINCT source.sha256 AS sha256, CAST(source.chunk.idx AS INTEGER) AS chunk_idx, CAST(s.no AS INTEGER) AS section_no
FROM (SELECT source, unnest([{'no': i - 1, 'md': note.sections[i].markdown} FOR i IN range(1, len(note.sections) + 1)]) AS s FROM envelope)
WHERE length(s.md) > (SELECT max_size FROM split_spec WHERE item_kind = 'section')
UNION
SELECT DISTINCT source.sha256, CAST(source.chunk.idx AS INTEGER), -1 FROM envelope
WHERE source.size > (SELECT max_size FROM split_spec WHERE item_kind = 'source') AND source.chunk.total = 1""",
)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    files = S.files_to_cut(read_table(spark, d, "envelope"), *_limits(spark, d)["source"]).filter("pieces > 1")
    sections = _pieces(spark, d).filter("piece_no = 1").select("sha256", "chunk_idx", "section_no")
    return sections.unionByName(files.select("sha256", "chunk_idx", F.lit(-1).alias("section_no")))


@REGISTRY.add("p3_pieces")
def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d)


@REGISTRY.add(
    "p3_files",
    """
SELECT DISTINCT source.sha256 AS sha256, CAST(source.chunk.idx AS INTEGER) AS chunk_idx, source.path AS path, source.size AS size,
  CAST(ceil((source.size - p.overlap) / (p.max_size - p.overlap)) AS INTEGER) AS pieces
FROM envelope, split_spec p WHERE p.item_kind = 'source' AND source.size > p.max_size AND source.chunk.total = 1""",
)
def p3_files(spark: SparkSession, d: str) -> DataFrame:
    return S.files_to_cut(read_table(spark, d, "envelope"), *_limits(spark, d)["source"])
