"""Filling fixed-capacity containers with texts (problem 6).

Only lengths are planned, not texts: the histogram of lengths, which has at most as many rows as a container has tokens, is packed best fit, longest first,
whole counts at a time. The plan is a list of runs: so many items of a length, from this rank on, go so many each into these containers at this offset.
Texts are ranked within their length, in buckets where many share one, and look up their run by binary search. A text larger than a container is cut into
full containers and a rest that is packed like a text.

The plan and the histogram are bounded by the capacity whatever the number of texts; nothing else is collected or sent.

Defined results: null and empty texts have no tokens and stand at the start of container 0. Texts of one length take their places in order of a hash of their
id, at every size, equal ids in any order. An empty table gives no rows. Equal texts are items of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .tokens import VOCABULARY, rank_within, token_sizes


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: (length, first rank, rank after the last, first container, items a container, offset in it)."""
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first container, number of containers)
    free: list[int] = []
    runs = []
    opened = 0

    def put(space: int, start: int, n: int) -> None:
        if space and n:
            if space not in room:
                insort(free, space)
                room[space] = []
            room[space].append((start, n))

    for length in sorted((x for x in counts if x > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(free, length)
            if i < len(free):
                space = free[i]
                start, n = room[space].pop()
                if not room[space]:
                    del room[space]
                    free.pop(i)
            else:
                space, start, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = space // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, rank + full * each, start, each, capacity - space))
                put(space - each * length, start, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                runs.append((length, rank, rank + left, start + full, left, capacity - space))
                put(space - left * length, start + full, 1)
                put(space, start + full + 1, n - full - 1)
                left = 0
            elif full < n:
                put(space, start + full, n - full)
    if counts.get(0):
        runs.append((0, 0, counts[0], 0, counts[0], 0))
    return runs


def _place(plans: dict[str, np.ndarray]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spec = np.array(b.column("spec").to_pylist(), object)
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("tokens", "rank"))
            container, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in set(spec):
                at = np.flatnonzero(spec == s)
                p = plans[s]
                width = int(p[:, 2].max()) + 1
                r = p[np.searchsorted(p[:, 0] * width + p[:, 1], length[at] * width + rank[at], "right") - 1]
                k = rank[at] - r[:, 1]
                container[at] = r[:, 3] + k // r[:, 4]
                offset[at] = r[:, 5] + k % r[:, 4] * length[at]
            yield pa.RecordBatch.from_arrays([b.column("spec"), b.column("row"), b.column("part"), b.column("tokens"), pa.array(container), pa.array(offset)], ["spec", "row", "part", "tokens", "container", "offset"])

    return run


def pack(df: DataFrame, text: Column, doc_id: Column, specs: list[tuple[str, int]], *, vocabulary: str = VOCABULARY) -> DataFrame:
    """(spec, doc_id, part, first_token, tokens, container, offset): the place of every text, or part of it, in the containers of each (name, capacity)."""
    sized = written(token_sizes(df, text, [doc_id.alias("doc_id")], vocabulary=vocabulary), "sizes")
    choices = F.array(*[F.struct(F.lit(s).alias("spec"), F.lit(c).cast("long").alias("capacity")) for s, c in specs])
    each = sized.select("doc_id", "tokens", F.explode(choices).alias("s")).select("doc_id", "tokens", "s.*")
    parts = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("tokens") / F.col("capacity")), F.lit(1)).cast("long") - 1)
    items = each.withColumn("part", F.explode(parts)).select("spec", F.struct("doc_id", (F.col("part") * F.col("capacity")).alias("first_token")).alias("row"), "part", F.least("capacity", F.col("tokens") - F.col("part") * F.col("capacity")).alias("tokens"))
    histogram: dict[str, dict[int, int]] = {s: {} for s, _ in specs}
    for r in items.groupBy("spec", "tokens").agg(F.count("*").alias("n")).collect():  # at most the sum of the capacities
        histogram[r["spec"]][r["tokens"]] = r["n"]
    plans = {s: np.array(sorted(plan_packing(histogram[s], c)), np.int64).reshape(-1, 6) for s, c in specs}
    ranked = rank_within(items, ["spec", "tokens"], ["row.doc_id", "part"], sum(sum(h.values()) for h in histogram.values()))
    long = T.LongType()
    schema = T.StructType([T.StructField("spec", T.StringType()), T.StructField("row", items.schema["row"].dataType), T.StructField("part", long), T.StructField("tokens", long), T.StructField("container", long), T.StructField("offset", long)])
    return ranked.select("spec", "row", "part", "tokens", "rank").mapInArrow(_place(plans), schema).select("spec", "row.doc_id", "part", "row.first_token", "tokens", "container", "offset")


def fill(places: DataFrame, capacity: DataFrame) -> DataFrame:
    """By spec: texts, parts, containers, tokens and the share of the containers' room that is used."""
    each = places.groupBy("spec").agg(F.count_if(F.col("part") == 0).alias("texts"), F.count("*").alias("parts"), (F.max("container") + 1).alias("containers"), F.sum("tokens").alias("tokens"))
    return each.join(capacity, "spec").withColumn("filled", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))
