"""Splitting oversized items at natural boundaries (problem 3), by lexical cohesion.

A text is seen as units: sentences, items, rows, headings. The likeness of the words in the blocks of ``BLOCK`` units before and after each gap is a curve whose
valleys mark changes of topic; the depth of a gap is what the curve rises to on both sides of it. A piece may end at any gap between half the limit and the
limit after its start; the deepest valley in that window is taken, the stronger boundary (heading, paragraph, line, sentence) among equal ones, then the later.
Where the window has no gap the earlier part is searched, then blanks, and a text without any is cut at the limit, never inside a character with its accents.
Each next piece starts ``overlap`` characters before the cut.

Defined results: null texts and texts within the limit give no piece; all others give two or more, none over the limit, that cover the text without a hole. The
overlap must be less than half the limit. Lengths are in code points, ends excluded. Rows delivered twice give their pieces once. Files are only listed, with
the number of pieces they need, as their bytes are not at hand.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 3
#: Between two units: the white space after a sentence end, line ends, paragraph breaks.
_GAP = re.compile(r"(?<=[.?!…:;])[\"»”)]?[^\S\r\n]+(?=\S)|(?<![^\S\r\n])[^\S\r\n]*(?:\r?\n[^\S\r\n]*)+")
_WORD = re.compile(r"[^\W\d_]{2,}")
_FENCE = re.compile(r"^ *(?:```|~~~)", re.M)


def gaps(text: str) -> list[tuple[int, int]]:
    """(position, strength) of each natural boundary; the position is the start of the unit after it. 4 before a heading, 3 between paragraphs, 2 between
    lines, 1 between sentences; 0 inside fenced code."""
    fences = [m.start() for m in _FENCE.finditer(text)]
    out, inside = [], 0
    for m in _GAP.finditer(text):
        p = m.end()
        if p >= len(text):
            break
        while inside < len(fences) and fences[inside] < p:
            inside += 1
        lines = m[0].count("\n")
        strength = 4 if lines and text[p] == "#" else 3 if lines > 1 else 2 if lines else 1
        out.append((p, 0 if inside % 2 else strength))
    return out


def likeness(text: str, places: list[int]) -> np.ndarray:
    """Of each gap: the cosine of the word counts of the blocks before and after it."""
    bounds = [0, *places, len(text)]
    bags = [Counter(w.lower() for w in _WORD.findall(text, a, b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    like = np.zeros(len(places))
    for i in range(len(places)):
        left, right = Counter(), Counter()
        for bag in bags[max(0, i + 1 - BLOCK) : i + 1]:
            left.update(bag)
        for bag in bags[i + 1 : i + 1 + BLOCK]:
            right.update(bag)
        norm = (sum(v * v for v in left.values()) * sum(v * v for v in right.values())) ** 0.5
        like[i] = sum(v * right[w] for w, v in left.items() if w in right) / norm if norm else 0.0
    return like


def depths(text: str, places: list[int]) -> np.ndarray:
    """Of each gap: how far the likeness of the blocks around it lies below the peaks on either side."""
    like = likeness(text, places)
    # The peak on a side is where the curve, followed from the gap, first falls: each gap has that of its neighbour unless the neighbour lies lower.
    peak_l, peak_r = like.tolist(), like.tolist()
    for i in range(1, len(like)):
        if like[i - 1] >= like[i]:
            peak_l[i] = peak_l[i - 1]
    for i in range(len(like) - 2, -1, -1):
        if like[i + 1] >= like[i]:
            peak_r[i] = peak_r[i + 1]
    return np.array(peak_l) + np.array(peak_r) - 2 * like


def _hard(text: str, at: int, least: int) -> int:
    """The last place up to ``at`` that is not inside a character with its accents, or between CR and LF."""
    p = at
    while p > least and (unicodedata.combining(text[p]) or text[p] in "‍️" or text[p - 1] in "‍" or text[p - 1 : p + 1] == "\r\n"):
        p -= 1
    return p if p > least else at


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, bool]]:
    """(start, end, does it end at a natural boundary) of each piece."""
    if len(text) <= limit:
        return [(0, len(text), True)]
    if not 0 <= overlap < limit / 2:
        raise ValueError("the overlap must be less than half the limit")
    found = gaps(text)
    places, strength = np.array([p for p, _ in found], int), np.array([s for _, s in found], int)
    deep = np.round(depths(text, places.tolist()), 6)
    out, start = [], 0
    while len(text) - start > limit:
        end, natural = None, True
        for lo, hi in ((start + limit // 2, start + limit), (start + overlap + 1, start + limit // 2)):
            first, after = np.searchsorted(places, (max(lo, start + overlap), hi), "right")
            at = first + np.flatnonzero(strength[first:after] > 0)
            if len(at):
                end = int(places[max(at, key=lambda i: (deep[i], strength[i], places[i]))])
                break
        if end is None:
            blank = max(text.rfind(c, start + limit // 2, start + limit) for c in " \n\t ")
            end, natural = (blank + 1, False) if blank > start + overlap else (_hard(text, start + limit, start + limit // 2), False)
        out.append((start, end, natural))
        start = end - overlap
    return [*out, (start, len(text), True)]


def section_texts(envelope: DataFrame) -> DataFrame:
    """(sha256, chunk_idx, section_no, text): the sections, numbered from 0."""
    return envelope.select(F.col("source.sha256").alias("sha256"), F.col("source.chunk.idx").cast("int").alias("chunk_idx"), F.posexplode("note.sections.markdown").alias("section_no", "text"))


def split_oversized(items: DataFrame, keys: list[str], text: str, limit: int, overlap: int) -> DataFrame:
    """(keys, piece_no, start, end, natural, text): the pieces of each text over the limit; equal keys once."""
    long = items.filter(F.length(text) > limit).groupBy(*keys).agg(F.min(text).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, no, ends, texts = [], [], [], []
            for i, t in enumerate(b.column("_text").to_pylist()):
                for k, piece in enumerate(split_text(t, limit, overlap)):
                    row.append(i)
                    no.append(k)
                    ends.append(piece)
                    texts.append(t[piece[0] : piece[1]])
            at = pa.array(row, pa.int64())
            columns = [b.column(k).take(at) for k in keys] + [pa.array(no, pa.int32()), pa.array([e[0] for e in ends], pa.int32()), pa.array([e[1] for e in ends], pa.int32()), pa.array([e[2] for e in ends], pa.bool_()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "piece_no", "start", "end", "natural", "text"])

    whole = T.IntegerType()
    schema = T.StructType([long.schema[k] for k in keys] + [T.StructField(n, t) for n, t in (("piece_no", whole), ("start", whole), ("end", whole), ("natural", T.BooleanType()), ("text", T.StringType()))])
    return long.mapInArrow(run, schema)


def files_to_cut(envelope: DataFrame, limit: int, overlap: int) -> DataFrame:
    """(sha256, chunk_idx, path, size, pieces): the files over the limit that came as one chunk, with the pieces they need."""
    e = envelope.select(F.col("source.sha256").alias("sha256"), F.col("source.chunk.idx").cast("int").alias("chunk_idx"), F.col("source.path").alias("path"), F.col("source.size").alias("size"), F.col("source.chunk.total").alias("total"))
    pieces = F.ceil((F.col("size") - overlap) / F.lit(limit - overlap)).cast("int")
    return e.filter((F.col("size") > limit) & (F.col("total") == 1)).select("sha256", "chunk_idx", "path", "size", pieces.alias("pieces")).distinct()
