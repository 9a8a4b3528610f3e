"""Cutting long documents into overlapping spans at headings, empty lines, line ends or blanks: a row generator over Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEAD = re.compile(r"^#{1,6} ", re.M)
LEAST_SIZE = 1_000


def boundary(text: str, lo: int, hi: int) -> int:
    """The best place to cut in the upper half of [lo, hi): the last heading, else after the last empty line, line end, blank, else hi."""
    if hi >= len(text):
        return len(text)
    mid = lo + max(1, (hi - lo) // 2)
    window = text[mid:hi]
    heads = [m.start() for m in _HEAD.finditer(window)]
    if heads:
        return mid + heads[-1]
    for sign in ("\n\n", "\n", " "):
        if (k := window.rfind(sign)) >= 0:
            return mid + k + len(sign)
    return hi


def spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans that cover the text, each starting after the one before; at least ``LEAST_SIZE`` long but for the last, overlapping by half a span at most."""
    size = max(LEAST_SIZE, size)
    overlap = max(0, min(overlap, size // 2))
    if len(text) <= size:
        return [(0, len(text))] if text else []
    out, start = [], 0
    while True:
        end = boundary(text, start, start + size)
        if end <= start:
            end = start + size
        out.append((start, end))
        if end >= len(text):
            return out
        # The next span starts at the best place of this one up to the overlap.
        back = boundary(text, start, max(start + 1, end - overlap))
        start = back if back > start else end


def document_spans(df: DataFrame, key: str, text: str, size: Column, overlap: Column) -> DataFrame:
    """(key, idx, start, end) of each document; null and empty texts have none."""
    src = df.select(key, F.col(text).alias("text"), size.cast("int").alias("size"), overlap.cast("int").alias("overlap"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, k, *s) for i, (t, n, o) in enumerate(zip(*(b.column(c).to_pylist() for c in ("text", "size", "overlap")), strict=True)) if t for k, s in enumerate(spans(t, n or 0, o or 0))]
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int32()) for c in cols[1:]]], [key, "idx", "start", "end"])

    return src.mapInArrow(run, T.StructType([src.schema[key], *[T.StructField(n, T.IntegerType()) for n in ("idx", "start", "end")]]))
