"""Sizes of texts in tokens of a public tokenizer, and ranks within groups that may be large."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: The vocabulary file, in the rank format, that sizes are measured by where a caller names no other.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How that tokenizer splits text before merging. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str):  # noqa: ANN201
    """The tokenizer of a rank file, read once a process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, text: Column, keep: list[Column], *, vocabulary: str = VOCABULARY, into: str = "tokens") -> DataFrame:
    """The columns ``keep`` and the number of tokens of each whole text; of a null text 0."""
    src = df.select(F.struct(*keep).alias("row"), text.cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(vocabulary).encode_ordinary
        for b in batches:
            n = [len(count(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(n, pa.int64())], ["row", "n"])

    out = src.mapInArrow(run, T.StructType([src.schema["row"], T.StructField("n", T.LongType())]))
    return out.select("row.*", F.col("n").alias(into))


def rank_within(df: DataFrame, group: list[str], order: list[str], rows: int, *, bucket_rows: int = 200_000, into: str = "rank") -> DataFrame:
    """``df`` with each row's place, from 0, in its group, in the order of a hash of ``order``, then of ``order`` itself, whatever the number of rows. A group may
    hold any share of the ``rows`` rows of ``df``: it is ranked in buckets, which are ranges of the hash, and their sizes, a few rows a group, are summed up before them."""
    buckets = max(1, math.ceil(rows / bucket_rows))
    h = df.withColumn("_hash", F.xxhash64(*order))
    inner = lambda *by: F.row_number().over(Window.partitionBy(*group, *by).orderBy("_hash", *order)).cast("long") - 1
    if buckets == 1:
        return h.withColumn(into, inner()).drop("_hash")
    b = h.withColumn("_bucket", F.least(F.floor((F.col("_hash").cast("double") / F.lit(2.0**64) + 0.5) * buckets), F.lit(buckets - 1)))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = b.groupBy(*group, "_bucket").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return b.withColumn("_inner", inner("_bucket")).join(starts, [*group, "_bucket"]).withColumn(into, F.col("_start") + F.col("_inner")).drop("_bucket", "_inner", "_start", "_hash")
