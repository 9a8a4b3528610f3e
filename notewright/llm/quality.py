"""Per-document text statistics and structure (problem 8).

One pass over the texts counts, for each document, words, symbols, line ends, character classes, the common words of every language, and how many of its
characters stand in lines shaped as sentences, list items, table rows or noise. The counts are written once; all that follows reads them, not the texts.

Profiles. Over all documents whose lines are mostly sentences, the counts of common words and of character classes are summed by language: a language's
prose profile. Function-word and character-class distributions of a document are compared with the profile of its language by Jensen-Shannon divergence
(in bits, 0 to 1). Text shaped as sentences that is far from prose in its words is noise. What then stands in each shape is the document's structural
distribution. Documents that are mostly of one shape are the examples of a kind, and their mean its structural profile; the kind is the nearest of the four
profiles by the same divergence.

Defined results: a null text has null figures and no kind; an empty one zeros. Texts under ``LEAST_CHARS`` characters have figures but no kind. Fenced code and
headings count for no kind, unless there is nothing else. Texts of any length are read whole. Equal rows each have their row; extra columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

KINDS = ("prose", "list", "table", "junk")
#: Structural profiles before any document is seen: how the characters of a kind spread over sentences, items, cells and noise. Fixed values.
STRUCTURES = {"prose": (0.94, 0.03, 0.01, 0.02), "list": (0.03, 0.94, 0.01, 0.02), "table": (0.01, 0.03, 0.94, 0.02), "junk": (0.02, 0.02, 0.02, 0.94)}
LEAST_CHARS = 40
#: Character classes: letters (and all beyond ASCII), digits, blanks, line ends, ends of sentences, inner punctuation, other ASCII.
CLASSES = ("letter", "digit", "blank", "newline", "stop", "inner", "symbol")
_CLASS = bytes(0 if i > 127 or chr(i).isalpha() else 1 if chr(i).isdigit() else 3 if chr(i) in "\r\n" else 2 if chr(i).isspace() else 4 if chr(i) in ".?!" else 5 if chr(i) in ",;:'-\"()" else 6 for i in range(256))
#: All but letters (and what is beyond ASCII) as a blank; all but white space as x.
_LETTERS = bytes(i if i > 127 or chr(i).isalpha() else 32 for i in range(256))
_INK = bytes(32 if chr(i).isspace() and i < 128 else 120 for i in range(256))
#: Punctuation and signs beyond ASCII, in UTF-8.
_SIGNS = re.compile(rb"\xe2[\x80-\xbf]{2}|\xc2[\x80-\xbf]|\xef\xbf\xbd")

_TERMINAL = re.compile(r"[.?!…。][\"'»”’)\]]*\s*$")
_BULLET = re.compile(r"\s*(?:[-*•‣◦▪●·+–—>]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])\s+(?:\[[ xX]\]\s+)?\S|\s*[☐☑✓✗]")
_RULE = re.compile(r"[\s|+:=─━┼│┌┐└┘├┤-]{3,}$")
_TAGGED = re.compile(r"</?t(?:able|r|d|h|body|head)\b", re.I)
_GAPS = re.compile(r"\S(?: {2,}|\t)(?=\S)")
_STACK = re.compile(r"\s*(?:at\s+[\w$.<>]+\(|File \"|\[?\d{4}-\d\d-\d\d[T ]\d\d:\d\d|\w+(?:\.\w+)*(?:Error|Exception)\b|0x[0-9a-f]+|[0-9a-f]{8}\s+(?:[0-9a-f]{2}\s+){4})")
_JSON = re.compile(r"[{\[]\s*[\"\[{]|\":\s*[\"{\[\d]")
#: A word with a sign or a digit between its letters, and how each of these ends, which is quickly looked for.
_MIXED = re.compile(r"[^\W\d_](?:[|~^$#*@=<>{}\\!;.:`%]|\d)+[^\W\d_]")
_MIXED_END = re.compile(r"[|~^$#*@=<>{}\\!;.:`%\d][^\W\d_]")
_MARKS = ("\t", "|", "│", "{", "}", "<", ">", "`", "#", "•", "☐", "☑", "✓", "  ", '","', ": ", ":\n", "\n-", "\n*", "\n–", "\n—", "\n·", "\n+", "\n◦", "\n▪", "\n‣", "\n -", "\n *", "\n(")
_NUMBERED = re.compile(r"^ ?\(?(?:\d{1,3}|[a-zA-Z])[.)]\s|^[0-9a-f]{8}\b|^ ?at ", re.M)
_ENDS = re.compile(r"[.?!…。][\"'»”’)\]]*[ \t\r]*(?=\n|\Z)")
_HEADING = re.compile(r"#{1,6} \S")
_LABEL = re.compile(r"[^:?!]{2,60}? ?: \S")
_LABELS = re.compile(r" (?:[|»>•·/–]|::) ")
_SENTENCE_STOP = re.compile(r"[.?!…]+[\"'»”’)\]]*(?:\s|$)")


def _cells(line: str) -> list[str] | None:
    """The cells of a table row, or null."""
    if "\t" in line.strip():
        return line.split("\t")
    for sep in ("|", "│", ";"):
        if line.count(sep) >= 2:
            cells = [c.strip() for c in line.split(sep)]
            if sep != ";" or all(len(c) < 60 for c in cells) and not _TERMINAL.search(line) and "; " not in line:
                return [c for c in cells if c] or [""]
    if line.count('","') >= 2 or line.count(",") >= 3 and ", " not in line:
        return line.split(",")
    s = line.strip()
    if len(_GAPS.findall(s)) >= 2:
        return re.split(r" {2,}", s)
    return None


#: Lines that the tests of bullets, stacks and rules may take, in a whole text.
_ODD_LINE = re.compile(rf"^(?:{_BULLET.pattern}|{_STACK.pattern}|[^\S\n]*[|+:=─━┼│┌┐└┘├┤-](?:[^\S\n]|[|+:=─━┼│┌┐└┘├┤-]){{2,}}$)", re.M)


def _odd(text: str, ink: bytes) -> bool:
    """May a line of the text be anything but running text? Then its lines are looked at one by one. True wherever a test of ``structure`` may fire."""
    if text.count(",") >= 3 and any(x.count(",") >= 3 and ", " not in x for x in text.split("\n")) or text.count(";") >= 2 and any(x.count(";") >= 2 and "; " not in x for x in text.split("\n")):
        return True
    if "~~~" in text or len(_LABELS.findall(text)) >= 7 or _JSON.search(text) or _ODD_LINE.search(text):
        return True
    return any(m in text for m in _MARKS) or text[:1] in "-*–—·+◦▪‣(" or text.count("»") > text.count("«") or text.count(";") >= 3 or text.rstrip().endswith(":") or b"x" * 46 in ink or bool(_NUMBERED.search(text))


def _shaped(block: list[str]) -> bool:
    """Are the lines of a block sentences, rather than items? Wrapped prose has long lines that go on; items end without a stop and start anew."""
    n = sum(map(len, block))
    whole = " ".join(block)
    stops = len(_SENTENCE_STOP.findall(whole))
    # Items in a row: many short pieces between the same signs, and hardly a sentence that ends.
    for sep in (" · ", " ; ", "; ", " • ", " / ", ", "):
        if (k := whole.count(sep)) >= 4 and n < 50 * (k + 1) and stops * 8 <= k + 8:
            return False
    if len(block) == 1:
        return stops > 0 or block[0].count(" ") > 6
    return stops * 6 >= len(block) or n / len(block) > 90


def structure(text: str, ink: bytes | None = None) -> tuple[int, int, int, int, int, int]:
    """Characters in sentences, items, cells, noise, lines that say nothing of the kind, and ragged rows: those that no row beside them has the cells of."""
    sentence = item = cell = noise = neutral = 0
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not _odd(text, text.encode("utf-8", "replace").translate(_INK) if ink is None else ink):
        lines = [x.strip() for x in text.split("\n")]
        seen = Counter(x for x in lines if x)
        block: list[str] = []
        for line in [*lines, ""]:
            if line:
                block.append(line)
            elif block:
                n = sum(map(len, block))
                if _shaped(block):
                    sentence += n
                else:
                    item += n
                block = []
        return *_repeated(seen, sentence, item, 0, 0, 0), 0
    lines = text.split("\n")
    fenced = False
    seen = Counter()
    block = []
    rows: list[tuple[int, int]] = []
    cells_seen: Counter[str] = Counter()
    row_chars = row_lines = ragged = 0

    def close() -> None:
        nonlocal sentence, item, noise
        if not block:
            return
        n = sum(map(len, block))
        if _shaped(block):
            sentence += n
        else:
            item += n
        block.clear()

    for line in lines:
        s = line.strip()
        if not s:
            close()
            continue
        n = len(s)
        if s.startswith(("```", "~~~")):
            close()
            fenced = not fenced
            neutral += n
            continue
        if fenced:
            neutral += n
            continue
        seen[s] += 1
        if s[0] == "#" and _HEADING.match(s):
            close()
            neutral += n
        elif _STACK.match(line) or _JSON.search(s) and s.count('"') * 8 > n or n > 45 and '","' not in s and s.count(";") < 3 and max(map(len, s.split())) > 45 and "http" not in s and not _TAGGED.search(s):
            close()
            noise += n
        elif _TAGGED.search(s):
            close()
            cell += n
        elif _RULE.match(s) and (("|" in s) or ("+" in s) or "─" in s or "│" in s or len(s) > 8):
            close()
            cell += n
        elif _BULLET.match(line):
            close()
            if _TERMINAL.search(s) and s.count(" ") >= 6:
                sentence += n
            else:
                item += n
        elif n > 60 and len(labels := _LABELS.split(s)) >= 8 and len(set(labels)) <= 0.7 * len(labels) and not any(c.isdigit() for c in s):
            close()
            noise += n
        elif (cells := _cells(line)) is not None:
            close()
            row_chars += n
            row_lines += 1
            cells_seen.update(cells)
            rows.append((len(cells), n))
        elif ":" in s and _LABEL.match(s) and not _TERMINAL.search(s) and n < 120:
            if block and len(block[-1]) > 45 and not _TERMINAL.search(block[-1]):
                block.append(s)
            else:
                close()
                item += n
        else:
            block.append(s)
    close()
    if row_lines:
        total, kinds = sum(cells_seen.values()), len(cells_seen)
        # Page furniture repeats its few labels in a line or two; a table has rows of differing cells.
        if row_lines <= 3 and total >= 8 and kinds <= 0.6 * total or row_lines <= 1 and total >= 8 and not any(any(c.isdigit() for c in x) for x in cells_seen):
            noise += row_chars
        else:
            ragged = sum(n for i, (k, n) in enumerate(rows) if all(k != x for x, _ in rows[max(0, i - 1) : i] + rows[i + 1 : i + 2]))
            cell += row_chars - ragged
    return *_repeated(seen, sentence, item, cell, noise, neutral), ragged


def _repeated(seen: Counter[str], sentence: int, item: int, cell: int, noise: int, neutral: int) -> tuple[int, int, int, int, int]:
    """The same few lines over and over are noise."""
    many = sum(seen.values())
    if many >= 6 and (len(seen) <= 0.15 * many or len(seen) <= 2):
        noise, sentence, item = noise + sentence + item, 0, 0
    return sentence, item, cell, noise, neutral


class Vocabulary:
    """The common words of all languages with their numbers."""

    def __init__(self, rows: Iterable[tuple[str, str]]) -> None:
        langs: dict[str, set[str]] = {}
        for lang, word in rows:
            if lang and word:
                langs.setdefault(word.lower().encode(), set()).add(lang)
        self.languages = sorted({x for ls in langs.values() for x in ls})
        self.words = sorted(langs)
        self.number = {w: i for i, w in enumerate(self.words)}
        #: weight[i, l]: 1 over the number of languages that have the word i, if l has it.
        self.weight = np.array([[(x in langs[w]) / len(langs[w]) for x in self.languages] for w in self.words]).reshape(len(self.words), len(self.languages))

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        c = Counter(words)
        hit = [w for w in c if w in self.number]
        return np.array([self.number[w] for w in hit], np.int32), np.array([c[w] for w in hit], np.int32)


_NUMBERS = ("chars", "words", "letters", "symbols", "lines", "stopped", "distinct", "mixed", "common", *(f"class_{c}" for c in CLASSES), *(f"in_{x}" for x in ("sentences", "items", "cells", "noise", "neither", "ragged")))
_COUNTS = [*[T.StructField(n, T.LongType()) for n in _NUMBERS], T.StructField("lang", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ns", T.ArrayType(T.IntegerType()))]


def count_text(text: str, vocabulary: Vocabulary) -> tuple[list[int], str | None, np.ndarray, np.ndarray]:
    """The counts of one document: ``_NUMBERS``, its likeliest language, the numbers of its common words and how often each occurs."""
    data = text.lower().encode("utf-8", "replace")
    spread = data.translate(_LETTERS)
    if b"\xe2" in spread or b"\xc2" in spread or b"\xef" in spread:
        spread = _SIGNS.sub(b" ", spread)
    words = spread.split()
    ids, ns = vocabulary.find(words)
    lang, common = None, 0
    if len(ids):
        has = vocabulary.weight[ids]
        best = int((ns @ has).argmax())
        lang, common = vocabulary.languages[best], int(ns[has[:, best] > 0].sum())
    kinds = data.translate(_CLASS)
    classes = [kinds.count(i) for i in range(len(CLASSES))]
    ink = data.translate(_INK)
    symbols = classes[1] + classes[6]
    mixed = len(_MIXED.findall(text)) if _MIXED_END.search(text) else 0
    lines = sum(1 for x in text.split("\n") if x and not x.isspace())
    return [len(text), len(words), len(b"".join(words).decode("utf-8", "replace")), symbols, lines, len(_ENDS.findall(text)), len(set(words)), mixed, common, *classes, *structure(text, ink)], lang, ids, ns


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int32)))


def _count(vocabulary: Vocabulary):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [None] * len(_NUMBERS), None, np.zeros(0, np.int32), np.zeros(0, np.int32)
        for b in batches:
            out = [none if t is None else count_text(t, vocabulary) for t in b.column("text").to_pylist()]
            numbers = [pa.array([x[0][i] for x in out], pa.int64()) for i in range(len(_NUMBERS))]
            yield pa.RecordBatch.from_arrays([b.column("row"), *numbers, pa.array([x[1] for x in out], pa.string()), _lists([x[2] for x in out]), _lists([x[3] for x in out])], ["row", *_NUMBERS, "lang", "ids", "ns"])

    return run


def text_counts(df: DataFrame, text: Column, vocabulary: Vocabulary, keep: list[str]) -> DataFrame:
    """Of each document the columns ``keep`` as the struct ``row`` and its counts, in one pass over the texts."""
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.cast("string").alias("text"))
    return src.mapInArrow(_count(vocabulary), T.StructType([src.schema["row"], *_COUNTS]))


class Prose:
    """Prose profiles by language: the distribution over the common words and all others, and over the character classes."""

    def __init__(self, languages: list[str], words: np.ndarray, others: np.ndarray, classes: np.ndarray) -> None:
        total = words.sum(axis=1) + others
        self.languages = languages
        self.words = np.concatenate([words, others[:, None]], axis=1) / np.maximum(total, 1)[:, None]
        self.classes = classes / np.maximum(classes.sum(axis=1), 1)[:, None]


def prose_profiles(counts: DataFrame, vocabulary: Vocabulary, *, sentences: float = 0.8, least_words: int = 30) -> Prose:
    """Profiles summed over all documents whose lines are mostly sentences; what is collected is bounded by languages x common words."""
    like = counts.filter(f"words >= {least_words} and lang is not null and in_sentences >= {sentences} * (in_sentences + in_items + in_cells + in_noise + in_ragged) and common >= 0.25 * words and mixed < 0.05 * words")
    n, at = len(vocabulary.words), {x: i for i, x in enumerate(vocabulary.languages)}
    words, others, classes = np.zeros((len(at), n)), np.zeros(len(at)), np.zeros((len(at), len(CLASSES)))
    pairs = like.select("lang", F.explode(F.arrays_zip("ids", "ns")).alias("p")).groupBy("lang", "p.ids").agg(F.sum("p.ns").alias("n")).toPandas()
    for r in pairs.itertuples():
        words[at[r.lang], r.ids] = r.n
    sums = like.groupBy("lang").agg(F.sum("words").alias("w"), *[F.sum(f"class_{c}").alias(c) for c in CLASSES]).toPandas()
    for r in sums.itertuples():
        classes[at[r.lang]] = r[3:]
        others[at[r.lang]] = max(0, r.w - words[at[r.lang]].sum())
    return Prose(vocabulary.languages, words, others, classes)


def _kl(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log2(p / q), 0.0)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits along the last axis."""
    m = (p + q) / 2
    return (_kl(p, m) + _kl(q, m)).sum(axis=-1) / 2


def word_divergence(doc: np.ndarray, ids: np.ndarray, ns: np.ndarray, words: np.ndarray, lang: np.ndarray, profiles: np.ndarray) -> np.ndarray:
    """Of each document's common words, and of its other words as one, against the profile of its language. ``doc`` is the document of each id. Words of
    the profile that a document lacks cost half their share."""
    n, other = len(words), profiles.shape[1] - 1
    rest = np.maximum(words - np.bincount(doc, ns, n), 0)
    doc, ids, ns = np.append(doc, np.arange(n)), np.append(ids, np.full(n, other)), np.append(ns, rest)
    p, q = ns / np.maximum(words, 1)[doc], profiles[lang[doc], ids]
    m = np.maximum((p + q) / 2, 1e-300)
    shared = np.bincount(doc, _kl(p, m) + _kl(q, m), n)
    return (shared + np.maximum(0.0, 1 - np.bincount(doc, q, n))) / 2


#: Text shaped as sentences is noise when the divergence of its words from prose is above FAR_WORDS + SMALL / words, or the share of common words is below
#: FEW_COMMON, or the divergence of its character classes above FAR_CLASSES, or the share of words mixed of letters and signs above FAR_MIXED. Items are noise
#: when so mixed, or when their words are far, hardly common and, for more than half of them, repeated; ragged rows when so mixed.
FAR_WORDS, SMALL, FEW_COMMON, FAR_CLASSES, FAR_MIXED, REPEATED = 0.21, 4.0, 0.16, 0.16, 0.12, 0.5
#: Share of a shape from which a document is an example of its kind.
EXAMPLE = 0.8


def shapes(numbers: dict[str, np.ndarray], lang: list[str | None], ids: pa.ListArray, ns: pa.ListArray, prose: Prose) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(divergence of words, of character classes, structural distribution) of each document; what is unlike prose in words or signs has become noise."""
    at = {x: i for i, x in enumerate(prose.languages)}
    code = np.array([at.get(x, -1) for x in lang], np.int64)
    known = (code >= 0) & (prose.words.sum(axis=1)[np.maximum(code, 0)] > 0) & (numbers["words"] > 0)
    lengths = np.diff(ids.offsets.to_numpy())
    doc = np.repeat(np.arange(len(lengths)), lengths)
    lo, hi = ids.offsets[0].as_py(), ids.offsets[len(ids)].as_py()
    flat = [x.values.slice(lo, hi - lo).to_numpy(zero_copy_only=False) for x in (ids, ns)]
    far_words = np.where(known, word_divergence(doc, flat[0], flat[1], numbers["words"], np.maximum(code, 0), prose.words), 1.0)
    classes = np.stack([numbers[f"class_{c}"] for c in CLASSES], 1).astype(float)
    share = classes / np.maximum(classes.sum(axis=1), 1)[:, None]
    far_classes = np.where(known, divergence(share, prose.classes[np.maximum(code, 0)]), 1.0)
    shape = np.stack([numbers[f"in_{x}"] for x in ("sentences", "items", "cells", "noise")], 1).astype(float)
    words = np.maximum(numbers["words"], 1)
    garbled = numbers["mixed"] / words > FAR_MIXED
    few = numbers["common"] / words < FEW_COMMON
    unlike = (far_words > FAR_WORDS + SMALL / words) | few | garbled | (far_classes > FAR_CLASSES)
    filler = (far_words > FAR_WORDS) & few & (numbers["distinct"] / words < REPEATED)
    for column, moved in ((0, unlike), (1, garbled | filler)):
        shape[:, 3] += np.where(moved, shape[:, column], 0)
        shape[:, column] = np.where(moved, 0, shape[:, column])
    shape[:, 2] += np.where(garbled, 0, numbers["in_ragged"])
    shape[:, 3] += np.where(garbled, numbers["in_ragged"], 0)
    empty = shape.sum(axis=1) == 0
    shape[empty, 0] = 1
    return far_words, far_classes, shape / shape.sum(axis=1)[:, None]


def judge(numbers: dict[str, np.ndarray], shape: np.ndarray, structures: np.ndarray) -> np.ndarray:
    """The number of the nearest structural profile by divergence, -1 for texts too short."""
    return np.where(numbers["chars"] >= LEAST_CHARS, divergence(shape[:, None, :], structures[None]).argmin(axis=1), -1)


def _batch(b: pa.RecordBatch, prose: Prose) -> tuple[dict[str, pa.Array], dict[str, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    col = dict(zip(b.schema.names, b.columns, strict=True))
    numbers = {n: col[n].fill_null(0).to_numpy(zero_copy_only=False) for n in _NUMBERS}
    return col, numbers, shapes(numbers, col["lang"].to_pylist(), col["ids"], col["ns"], prose)


def _examples(prose: Prose):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, numbers, (_, _, shape) = _batch(b, prose)
            sure = (shape.max(axis=1) >= EXAMPLE) & (numbers["chars"] >= LEAST_CHARS)
            kind = shape.argmax(axis=1)
            sums = np.stack([shape[sure & (kind == k)].sum(axis=0) for k in range(len(KINDS))])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(KINDS)), pa.int64()), *[pa.array(sums[:, i]) for i in range(len(KINDS))]], ["kind", *KINDS])

    return run


def structural_profiles(counts: DataFrame, prose: Prose) -> np.ndarray:
    """The mean distribution of sentences, items, cells and noise over all documents that are examples of a kind, beside ``STRUCTURES``, which count as one
    more example each and keep all shares above zero. A row a kind is collected."""
    out = np.array([STRUCTURES[k] for k in KINDS])
    sums = counts.mapInArrow(_examples(prose), "kind bigint, " + ", ".join(f"{k} double" for k in KINDS)).groupBy("kind").agg(*[F.sum(k).alias(k) for k in KINDS]).collect()
    for r in sums:
        out[r["kind"]] += [r[k] for k in KINDS]
    return out / out.sum(axis=1)[:, None]


def _kinds(prose: Prose, structures: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*KINDS, None], object)
        for b in batches:
            col, numbers, (far_words, far_classes, shape) = _batch(b, prose)
            null = col["chars"].is_null().to_numpy(zero_copy_only=False)
            kind = judge(numbers, shape, structures)
            figures = [pa.array(np.round(x, 6), pa.float64(), mask=null) for x in (far_words, far_classes)]
            keep = [n for n in b.schema.names if n not in ("ids", "ns")]
            yield pa.RecordBatch.from_arrays([*[col[n] for n in keep], *figures, pa.array(np.where(null, None, names[kind]), pa.string())], [*keep, "far_words", "far_classes", "kind"])

    return run


def text_quality(df: DataFrame, text: Column, common_words: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each document with its figures, its divergences from prose and its kind."""
    vocabulary = Vocabulary((r.lang, r.word) for r in common_words.select("lang", "word").distinct().collect())  # the fixed table of common words
    counts = written(text_counts(df, text, vocabulary, keep), "text-counts")
    kept = [f for f in counts.schema.fields if f.name not in ("ids", "ns")]
    schema = T.StructType([*kept, T.StructField("far_words", T.DoubleType()), T.StructField("far_classes", T.DoubleType()), T.StructField("kind", T.StringType())])
    prose = prose_profiles(counts, vocabulary)
    judged = counts.mapInArrow(_kinds(prose, structural_profiles(counts, prose)), schema)
    share = lambda a, n: F.round(F.col(a) / F.greatest(F.col(n), F.lit(1)), 6)
    figures = ["words", share("letters", "words").alias("mean_word_length"), share("symbols", "chars").alias("symbol_ratio"), "lines", share("stopped", "lines").alias("lines_stopped"), share("common", "words").alias("common_share"), share("distinct", "words").alias("distinct_share"), share("mixed", "words").alias("mixed_share"), F.col("lang").alias("prose_lang")]
    shapes = [f"in_{x}" for x in ("sentences", "items", "cells", "noise", "neither", "ragged")]
    return judged.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *figures, *shapes, "far_words", "far_classes", "kind")
