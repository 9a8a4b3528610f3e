"""Near-duplicate pages (rule R15): pages of like length whose texts match by more than 92 % over their first 3,000 characters.

The ratio (matching blocks, with frequent signs as noise) has no exact index. Each text gets a MinHash sketch of its five-word shingles, ``SKETCH`` values; pages
that agree in one of the ``SKETCH / 2`` bands of two values are candidates. Sketches are of fixed size, made where the text is read, so nothing is shuffled for each
shingle, and frequent phrases join nothing by themselves. A band that more than ``HOT`` pages share is cut by a further pair of values of the sketch, as often as
there are other bands, so pages alike in two bands still meet. Candidates whose sketches agree in fewer than ``AGREE`` values are dropped before any text is read.
Cheap bounds (signs in common, shared q-grams) come before the exact ratio. Of copies with single words altered, over 98 % of the pairs above the limit are found
(measured against all pairs in the tests); pairs whose edits are spread over every few signs share no shingle and are not.

Identical bodies are one class, not pairs. Null and short bodies take no part. Equal keys are one page.
"""

from __future__ import annotations

import difflib
import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

LIMIT, PREFIX, LEAST, Q = 0.92, 3_000, 200, 5
#: Characters of a step of length; only pages of one step or two neighbouring ones are compared.
STEP = 500
#: Words of a shingle, values of a sketch, values in which candidates agree at least, and pages that may share a band undivided.
WORDS, SKETCH, AGREE, HOT = 5, 64, 8, 500


def quick_bound(a: str, b: str) -> float:
    """The most that the ratio can be, by the signs in common."""
    x, y = Counter(a), Counter(b)
    return 2 * sum(min(n, y[c]) for c, n in x.items()) / max(1, len(a) + len(b))


def shared_grams_bound(a: str, b: str, limit: float = LIMIT, q: int = Q) -> bool:
    """May the ratio be above the limit? Matching so much leaves at least so many q-grams whole."""
    s = len(a) + len(b)
    need = limit / 2 * s - (q - 1) * ((1 - limit) * s + 1)
    x, y = (Counter(t[i : i + q] for i in range(len(t) - q + 1)) for t in (a, b))
    return sum(min(n, y[g]) for g, n in x.items()) >= need


def ratio(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if quick_bound(a, b) <= LIMIT or not shared_grams_bound(a, b):
        return 0.0
    return difflib.SequenceMatcher(None, a, b).ratio()


def _ratios(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        r = [ratio(x, y) for x, y in zip(b.column("ta").to_pylist(), b.column("tb").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(r)], ["a", "b", "ratio"])


_WORD = re.compile(r"[^\W_]+")
_MIX = np.random.default_rng(15).integers(1, 1 << 63, (2, SKETCH), dtype=np.uint64) | np.uint64(1)
_STEPS = np.random.default_rng(16).integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


class _Hashes(dict[str, int]):
    """Hashes of words, the same in every process."""

    def __missing__(self, w: str) -> int:
        if len(self) > 1 << 17:
            self.clear()
        self[w] = h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        return h


def sketch(text: str, hashes: _Hashes) -> np.ndarray:
    """The smallest values of the text's five-word shingles under ``SKETCH`` hash functions; a shorter text is one shingle."""
    h = np.array([hashes[w] for w in _WORD.findall(text.lower())] or [0], np.uint64)
    n = max(1, len(h) - WORDS + 1)
    shingles = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(h))):
        shingles += h[i : i + n] * _STEPS[i]
    shingles ^= shingles >> np.uint64(29)
    mixed = shingles[None, :] * _MIX[0][:, None] + _MIX[1][:, None]
    return (mixed ^ mixed >> np.uint64(31)).min(axis=1)


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for b in batches:
        s = np.array([sketch(t, hashes) for t in b.column("t").to_pylist()], np.uint64).reshape(b.num_rows, SKETCH)
        short = (s >> np.uint64(32)).astype(np.uint32).view(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, short.size + 1, SKETCH), pa.int32()), pa.array(short.ravel()))
        yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "sketch"])


def _bands(sketches: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(SKETCH // 2 - 1)), lambda i: F.xxhash64(i, F.get(sketches, 2 * i), F.get(sketches, 2 * i + 1)))


def candidate_pairs(sketched: DataFrame, *, hot: int = HOT) -> DataFrame:
    """(a, b): pages (id, k, n, ord, sketch) that share a band and whose lengths and sketches are near enough; a stands before b. Bands travel with the page's
    number and length only."""
    bands = sketched.select("id", "n", F.explode(_bands(F.col("sketch"))).alias("band"))
    large = bands.groupBy("band").agg(F.count("*").alias("m")).filter(F.col("m") > hot).select("band")
    if large.limit(1).count():
        large = written(large, "hot-bands")
        within = bands.join(large, "band").select("id", "n", F.col("band").alias("first"))
        other = sketched.select("id", F.explode(_bands(F.col("sketch"))).alias("second"))
        cut = within.join(other, "id").filter("first <> second").select("id", "n", F.xxhash64("first", "second").alias("band"))
        bands = bands.join(large, "band", "left_anti").select("id", "n", "band").unionByName(cut)
    side = lambda x: bands.select("band", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n")])
    near = (F.abs(F.col("n_a") - F.col("n_b")) <= 0.25 * F.greatest("n_a", "n_b")) & (F.abs(F.floor(F.col("n_a") / STEP) - F.floor(F.col("n_b") / STEP)) <= 1)
    # The ratio is 2 M / (a + b) of the first characters, and M is at most the shorter of them.
    a, b = (F.least(c, F.lit(PREFIX)) for c in ("n_a", "n_b"))
    met = side("a").join(side("b"), "band").filter((F.col("id_a") < F.col("id_b")) & near & (2 * F.least(a, b) > LIMIT * (a + b)))
    pairs = met.select("id_a", "id_b").distinct()
    s = lambda x: sketched.select(F.col("id").alias(f"id_{x}"), F.struct("ord", "k").alias(x), F.col("sketch").alias(f"s{x}"))
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    both = pairs.join(s("a"), "id_a").join(s("b"), "id_b").filter(agree >= AGREE)
    return both.select(F.least("a", "b").k.alias("a"), F.greatest("a", "b").k.alias("b"))


def near_duplicates(pages: DataFrame, key: str, body: str, order: Column | None = None) -> DataFrame:
    """(a, b, ratio): pairs of representatives, the smallest key of each text, with different texts that match above the limit. The ratio depends on the order of
    the two texts: a is the text of the lower step of length, then that of the first page by ``order`` (without one, by key)."""
    p = pages.filter((F.length(body) >= LEAST) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(body).alias("body"), F.struct(F.floor(F.length(body) / STEP), *([order] if order is not None else []), F.col(key)).alias("ord"))
    # By the digest of the whole body: longer texts may begin alike and differ after that, and are a pair.
    one = p.groupBy(F.sha2("body", 256).alias("h")).agg(F.min("ord").alias("ord"), F.min_by(F.struct("k", F.left("body", F.lit(PREFIX)).alias("t"), F.length("body").alias("n")), "k").alias("r")).select("ord", "r.*")
    one = one.mapInArrow(_sketches, T.StructType([*one.schema.fields, T.StructField("sketch", T.ArrayType(T.IntegerType()))]))
    one = written(one.withColumn("id", F.monotonically_increasing_id()), "bodies")
    pairs = written(candidate_pairs(one.select("id", "k", "n", "ord", "sketch")), "candidates")
    full = pairs.join(one.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a").join(one.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")
    tasks = max(4 * pages.sparkSession.sparkContext.defaultParallelism, pairs.count() // 2_000)
    return full.select("a", "b", "ta", "tb").repartition(tasks, "a", "b").mapInArrow(_ratios, "a string, b string, ratio double").filter(F.col("ratio") > LIMIT)


def text_classes(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(key, class): each page with the smallest key that has the same body."""
    p = pages.filter(F.length(body) >= LEAST).select(F.col(key).alias("key"), F.sha2(body, 256).alias("h"))
    return p.join(p.groupBy("h").agg(F.min("key").alias("class")), "h").select("key", "class")
