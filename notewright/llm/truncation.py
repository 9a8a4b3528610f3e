"""Text cut off by field limits (problem 5).

Per source and field, histograms of the lengths in characters and in bytes are searched for spikes: a length that many more values have than the
lengths around it is a limit at which values were cut. A value at a spike without terminal punctuation was cut there. Values cut mid-transfer have any
length; what they share with the others is an ending that no whole text has. So the exact check that follows looks at how the text ends:

* a mark that the rest was left out, a broken character, an open bracket, quotation, tag or entity;
* a last word that is nowhere a whole word but begins other words of the corpus;
* a last phrase after which the corpus always goes on. Contexts of one to ``MAX_CONTEXT`` words before the end are counted over all texts; the longest
  context met ``MIN_SEEN`` times decides by the share of its occurrences that end a sentence (for a title: a title).

The second and third test need a smaller proof for a value at a spike. Counts cover every text of the corpus; to keep them small, contexts that no value
ends with are dropped where they are made, by a Bloom filter of bounded size. The filter is all that is broadcast.

Defined results: null, empty and blank values, and values of which nothing speaks for a cut, are no cases; equal rows count once. A corpus without any
context of a value gives no verdict by counts. Values may have any length. A source name that is null is a source of its own.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written

MAX_CONTEXT, MIN_SEEN = 7, 8
#: Most words (of 64 bits) of the Bloom filter: 32 MB. It grows with what is asked for up to that; beyond, it lets more pass, which changes no result.
BLOOM_MOST = 1 << 22
#: A context ends texts when at least this share of its occurrences does: at a spike, elsewhere.
END_SHARE = {"spike": 0.35, "any": 0.03}

#: Marks that the rest was left out. Fixed values.
LEFT_OUT = re.compile(r"(?:…|\.\.\.+|\.\s\.\s\.|[\[(<]\s*(?:…|\.{2,}|suite|à suivre|tronqué\w*|coupé\w*|truncated|cut|more|continued|to be continued|sigue|cortado|continua|gekürzt|fortsetzung|segue|troncato|cortado)[^\])>]{0,20}[\])>]|\b(?:lire la suite|read more|voir plus))\s*$", re.I)
BROKEN = re.compile(r"(?:�|&#?\w{0,9}|<[^<>]{0,60}|\]?\[[^\[\]]*|\*\*[^*]*|`[^`]*|\\|[\w/]+://\S{0,3}|\S-|%[0-9A-Fa-f]?)$")
TERMINAL = re.compile(r"[.?!。]['\"»”’)\]]*$")
PAIRS = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "„": "“", "‹": "›"}
_TOKEN = re.compile(r"\w+(?:['’]\w+)*['’]?|[^\w\s]")


_DIGITS = re.compile(r"\d+")


def fold_text(s: str) -> str:
    """Lower case without accents, numbers as 0."""
    s = s.casefold()
    if not s.isascii():
        s = unicodedata.normalize("NFKD", s)
        for c in {*s}:
            if c > "\u02ff" and unicodedata.combining(c):
                s = s.replace(c, "")
    return _DIGITS.sub("0", s).replace("’", "'")


def _open(text: str) -> bool:
    """Does the text end inside a bracket, a quotation or a markup sign?"""
    stack: list[str] = []
    for c in text:
        if c in PAIRS and not (c == "“" and stack and stack[-1] == "„"):
            stack.append(c)
        elif stack and PAIRS[stack[-1]] == c:
            stack.pop()
    if stack:
        return True
    if sum(1 for m in re.finditer(r"\"", text)) % 2:
        return True
    return text.count("**") % 2 == 1 or text.count("`") % 2 == 1 or bool(re.search(r"[\[(«“]$", text))


def ending_mark(text: str) -> str | None:
    """What in the form of the ending shows a cut."""
    t = text.rstrip()
    if LEFT_OUT.search(t):
        return "mark"
    if "�" in t[-2:]:
        return "broken character"
    if _open(t):
        return "open"
    if m := BROKEN.search(t):
        return "broken" if not re.fullmatch(r"[\w/]+://\S*", m[0]) else "broken link"
    if t.endswith((",", ";", ":", "/", "(", "-", "–", "—", "'", "’", "&", "+", "=")):
        return "goes on"
    return None


_STOPS = re.compile(r"[.?!…]+")
_WORDS = re.compile(r"\w+")
_LINES = re.compile(r"[\r\n]+| / ")


def sentences(folded: str) -> Iterator[tuple[list[str], bool]]:
    """(tokens from the last sentence end on, does it end there) of each sentence of a folded text."""
    for line in _LINES.split(folded):
        parts = _STOPS.split(line)
        for i, part in enumerate(parts):
            if run := _TOKEN.findall(part):
                yield run, i < len(parts) - 1


def without_mark(text: str) -> str:
    """The text without a mark that the rest was left out; texts that cannot end with one are not searched."""
    end = text.rstrip()[-3:]
    return LEFT_OUT.sub("", text) if end[-1:] in "…)]>eEsS" or end in ("...", ". .") else text


def _hash(field: str, words: Sequence[str]) -> int:
    return xxhash.xxh64_intdigest(field + "\x1f" + " ".join(words)) - (1 << 63)


def final_contexts(field: str, text: str) -> list[int]:
    """Hashes of the contexts of growing length at the end of a text; the sentence start counts as a word."""
    last: list[str] = []
    for run, _ in sentences(fold_text(text)):
        last = run
    words = ["^", *last]
    return [_hash(field, words[-k:]) for k in range(1, min(MAX_CONTEXT, len(words)) + 1)] if last else []


class Asked:
    """A Bloom filter of 64-bit hashes: may one have been asked for? The number of bits is a power of two."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.last = bits.tobytes(), len(bits) * 64 - 1

    def __contains__(self, h: int) -> bool:
        x, y = h & self.last, h >> 27 & self.last
        return bool(self.bits[x >> 3] >> (x & 7) & self.bits[y >> 3] >> (y & 7) & 1)


def bloom_words(asked: int) -> int:
    """Words of 64 bits for so many hashes: 16 bits each, up to ``BLOOM_MOST`` words."""
    return min(BLOOM_MOST, 1 << max(0, (max(asked, 1) * 16 - 1).bit_length() - 6))


def bloom(hashes: DataFrame, words: int) -> np.ndarray:
    """A Bloom filter of so many words, a power of two, of the column ``h``."""
    at = lambda s: F.struct((F.shiftright(F.col("h"), s + 6).bitwiseAND(F.lit(words - 1))).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(shiftright(h, {s}) & 63 as int))").alias("b"))
    rows = hashes.select(F.explode(F.array(at(0), at(27))).alias("x")).groupBy("x.w").agg(F.bit_or("x.b").alias("b")).toPandas()
    bits = np.zeros(words, np.uint64)
    bits[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).view(np.uint64)
    return bits


class _Firsts(dict[str, bool]):
    """Does a word begin an asked pair of words? Each is looked up once."""

    def __init__(self, asked: Asked) -> None:
        self.asked = asked

    def __missing__(self, word: str) -> bool:
        if len(self) > 1 << 19:
            self.clear()
        self[word] = x = _hash("1", [word]) in self.asked
        return x


class _Contexts(dict[tuple[str, ...], int | None]):
    """The hashes of contexts that were asked for, null for others; each is looked up once."""

    def __init__(self, field: str, asked: Asked) -> None:
        self.field, self.asked = field, asked

    def __missing__(self, words: tuple[str, ...]) -> int | None:
        if len(self) > 1 << 19:
            self.clear()
        self[words] = x = h if (h := _hash(self.field, words)) in self.asked else None
        return x


class Corpus:
    """Counts, over texts, of the contexts and words that are asked for. A context can only have been asked for if all shorter ones at its place were: pairs of
    words are counted first and looked up once each, and only where a pair was asked for are longer contexts looked at."""

    def __init__(self, asked: Asked) -> None:
        self.asked = asked
        self.known: dict[str, _Contexts] = {}
        self.parts: dict[str, list[tuple[int, bool]]] = {}
        self.firsts = _Firsts(asked)

    def contexts(self, field: str, folded: str, whole_text: bool, pairs: Counter[tuple[str, str]], ends_in: Counter[tuple[str, str]], longer: Counter[tuple[int, bool]]) -> None:
        """Adds the pairs (word before, word), those that end a sentence apart, and the asked contexts of three words or more. The last words of a text
        without a full stop are no evidence in running text; in titles (``whole_text``) they are the only end."""
        runs = list(sentences(folded))
        inner: list[tuple[str, str]] = []
        known = self.known.setdefault(field, _Contexts(field, self.asked))
        for i, (run, ends) in enumerate(runs):
            words = ("^", *run)
            two = list(zip(words, run))  # noqa: B905
            closed = ends or whole_text or i < len(runs) - 1
            last = two.pop()
            inner += two
            if closed:
                ends_in[last] += 1
                two.append(last)
            for j in [j for j, p in enumerate(two, 1) if known[p] is not None]:
                for k in range(3, min(MAX_CONTEXT, j + 1) + 1):
                    if (h := known[words[j - k + 1 : j + 1]]) is None:
                        break
                    longer[h, j == len(run)] += 1
        pairs.update(inner)

    def begun(self, item: str, before: int) -> list[tuple[int, bool]]:
        """(hash, is it the whole) of the asked beginnings of a word or pair of words, of at least one sign of the last one."""
        if item not in self.parts:
            found = ((_hash("w", [item[:k]]), k == len(item)) for k in range(before + 1, len(item) + 1))
            self.parts[item] = [x for x in found if x[0] in self.asked]
        return self.parts[item]

    def words(self, text: str, folded: str, seen: Counter[str | tuple[str, str]]) -> None:
        """Words, and pairs whose first word begins an asked pair, but for those at the very end of a text that a cut may have shortened."""
        bare = without_mark(text)
        words = _WORDS.findall(folded if bare == text else fold_text(bare))
        if words and (bare != text or not TERMINAL.search(text.rstrip())):
            words.pop()
        seen.update(words)
        seen.update([p for p in pairwise(words) if self.firsts[p[0]]])


def envelope_values(envelope: DataFrame) -> DataFrame:
    """(sha256, chunk_idx, area, field, value): summaries and titles, rows delivered twice once."""
    e = envelope.select(F.col("source.sha256").alias("sha256"), F.col("source.chunk.idx").cast("int").alias("chunk_idx"), F.substring_index("source.path", "/", 1).alias("area"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"note.{f}").alias("value")) for f in ("summary", "title")])).alias("v"))
    return e.select("sha256", "chunk_idx", "area", "v.*").filter("trim(value) <> ''").distinct()


def envelope_corpus(envelope: DataFrame) -> DataFrame:
    """(field, text, whole_text): the texts whose words and endings are counted."""
    running = F.concat(F.array(F.col("note.summary")), F.coalesce(F.col("note.sections.markdown"), F.array()), F.coalesce(F.col("entities.definition"), F.array()), F.coalesce(F.col("entities.evidence"), F.array()))
    text = envelope.select(F.lit("summary").alias("field"), F.explode(running).alias("text"), F.lit(False).alias("whole_text"))
    titles = envelope.select(F.lit("title").alias("field"), F.col("note.title").alias("text"), F.lit(True).alias("whole_text"))
    return text.unionByName(titles).filter("text is not null")


def length_spikes(values: DataFrame, *, least: int = 4, times: float = 6.0, around: int = 20, above: float = 0.75) -> DataFrame:
    """(area, field, unit, length, n, usual, longer): lengths near the maximum (at most the share ``above`` of the values is longer) that at least ``least``
    different values have, and ``times`` as many as the lengths around it on average."""
    units = F.array(F.struct(F.lit("chars").alias("unit"), F.length("value").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.octet_length("value").alias("length")))
    counts = values.select("area", "field", F.xxhash64("value").alias("hash"), F.explode(units).alias("u")).groupBy("area", "field", "u.unit", "u.length").agg(F.count_distinct("hash").alias("n"))
    w = Window.partitionBy("area", "field", "unit").orderBy("length").rangeBetween(-around, around)
    whole = Window.partitionBy("area", "field", "unit")
    longer = F.coalesce(F.sum("n").over(whole.orderBy("length").rowsBetween(1, Window.unboundedFollowing)), F.lit(0)) / F.sum("n").over(whole)
    near = counts.withColumn("usual", (F.sum("n").over(w) - F.col("n")) / (2 * around)).withColumn("longer", longer)
    return near.filter((F.col("n") >= least) & (F.col("n") >= times * F.col("usual")) & (F.col("longer") <= above))


def _evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds: mark, terminal, the final contexts, the last word without and with the word before it, and that word; all as hashes."""
    for b in batches:
        marks, terminal, ctx, word, first = [], [], [], [], []
        for field, v in zip(b.column("field").to_pylist(), b.column("value").to_pylist(), strict=True):
            t = v.rstrip()
            marks.append(ending_mark(v))
            terminal.append(bool(TERMINAL.search(t)) or bool(re.search(r"\betc\.?$", t)))
            ctx.append([] if marks[-1] or terminal[-1] else final_contexts(field, v))
            m = re.search(r"(?:(\w+)\W{1,3})?(\w+)$", t)
            asks = m is not None and not terminal[-1] and not m[2].isdigit()
            word.append([_hash("w", [fold_text(x)]) for x in (m[2], m[1] and f"{m[1]} {m[2]}") if x] if asks else [])
            first.append([_hash("1", [fold_text(m[1])])] if asks and m[1] else [])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(marks, pa.string()), pa.array(terminal, pa.bool_()), *[pa.array(x, pa.list_(pa.int64())) for x in (ctx, word, first)]], [*b.schema.names, "mark", "terminal", "ctx", "word", "first"])


def _count_corpus(bits: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = Corpus(Asked(bits))
        for b in batches:
            pairs: dict[str, tuple[Counter[tuple[str, str]], Counter[tuple[str, str]]]] = {}
            seen: Counter[tuple[int, bool]] = Counter()
            words: Counter[str | tuple[str, str]] = Counter()
            for field, text, whole in zip(b.column("field").to_pylist(), b.column("text").to_pylist(), b.column("whole_text").to_pylist(), strict=True):
                folded = fold_text(text)
                corpus.contexts(field, folded, whole, *pairs.setdefault(field, (Counter(), Counter())), seen)
                corpus.words(text, folded, words)
            for field, end, pair, k in ((f, e, p, k) for f, both in pairs.items() for e, c in zip((False, True), both, strict=True) for p, k in c.items()):
                for words_ in (pair[1:], pair):
                    if (h := corpus.known[field][words_]) is not None:
                        seen[h, end] += k
            n: dict[int, list[int]] = {}
            for (h, end), k in seen.items():
                x = n.setdefault(h, [0, 0, 0, 0])
                x[0] += k
                x[1] += k * end
            for item, k in words.items():
                for h, whole in corpus.begun(item, 0) if isinstance(item, str) else corpus.begun(" ".join(item), len(item[0]) + 1):
                    n.setdefault(h, [0, 0, 0, 0])[2 if whole else 3] += k
            if len(corpus.parts) > 1 << 19:
                corpus.parts.clear()  # what is kept is only kept to be quick
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), *[pa.array([x[i] for x in n.values()], pa.int64()) for i in range(4)]], ["h", "n", "ends", "inside", "longer"])

    return run


def corpus_counts(values: DataFrame, corpus: DataFrame) -> DataFrame:
    """(h, n, ends, inside, longer): over all texts, how often each context that a value ends with occurs and ends a sentence, and how often each last word (or
    pair) stands inside a text and begins a longer one. One pass; what no value asks for is mostly dropped where it is made, by a Bloom filter."""
    asked = values.select(F.explode(F.concat("ctx", "word", "first")).alias("h"))
    bits = bloom(asked, bloom_words(values.agg(F.sum(F.size("ctx") + F.size("word") + F.size("first")).alias("n")).first()["n"] or 0))
    sums = [F.sum(c).alias(c) for c in ("n", "ends", "inside", "longer")]
    return corpus.select("field", "text", "whole_text").mapInArrow(_count_corpus(bits), "h bigint, n bigint, ends bigint, inside bigint, longer bigint").groupBy("h").agg(*sums)


def truncation_evidence(values: DataFrame, corpus: DataFrame, *, least_longer: int = 3, rare: float = 0.01) -> DataFrame:
    """The values with their evidence: mark, terminal, spike, half, end_share, seen, and the verdict ``cut``. A last word, or pair of words, is half a word if it
    begins at least ``least_longer`` occurrences of longer ones and stands inside texts nowhere (or ``rare``-ly against those)."""
    columns = values.columns
    v = written(values.mapInArrow(_evidence, ", ".join(f"{n} {t}" for n, t in values.dtypes) + ", mark string, terminal boolean, ctx array<bigint>, word array<bigint>, first array<bigint>"), "endings")
    spikes = length_spikes(v)
    chars, octets = (spikes.filter(F.col("unit") == u).select("area", "field", F.col("length").alias(f"{u}_at"), F.lit(True).alias(f"{u}_spike")) for u in ("chars", "bytes"))
    at = v.withColumn("chars_at", F.length("value")).withColumn("bytes_at", F.octet_length("value"))
    for s, u in ((chars, "chars"), (octets, "bytes")):
        s = s.withColumnRenamed("area", "a").withColumnRenamed("field", "f").withColumnRenamed(f"{u}_at", "l")
        at = at.join(s, F.col("area").eqNullSafe(F.col("a")) & (F.col("field") == F.col("f")) & (F.col(f"{u}_at") == F.col("l")), "left").drop("a", "f", "l")
    at = at.withColumn("spike", F.coalesce("chars_spike", "bytes_spike", F.lit(False))).drop("chars_at", "bytes_at", "chars_spike", "bytes_spike")
    counted = written(corpus_counts(v, corpus), "corpus-counts")
    contexts = counted.filter(F.col("n") >= MIN_SEEN).select("h", "ends", "n")
    key = ["sha256", "chunk_idx", "field", "value"]
    best = v.select(*key, F.posexplode("ctx").alias("k", "h")).join(contexts, "h").groupBy(*key).agg(F.max_by(F.struct("ends", "n", "k"), "k").alias("best"), F.min_by(F.struct("ends", "n", "k"), "k").alias("word1"))
    half = counted.filter((F.col("longer") >= least_longer) & (F.col("inside") <= rare * F.col("longer"))).select("h")
    halves = v.select(*key, F.explode("word").alias("h")).join(half, "h", "left_semi").select(*key).distinct().withColumn("half", F.lit(True))
    out = at.join(best, key, "left").join(halves, key, "left")
    # A title counts its own end; that end is no evidence.
    share = F.greatest(F.col("best.ends") - F.when(F.col("field") == "title", 1).otherwise(0), F.lit(0)) / F.col("best.n")
    # A last word that, however often met, never ends a text: an article, a preposition.
    leads = F.coalesce((F.col("word1.k") == 0) & (F.col("word1.n") >= 50) & (F.col("word1.ends") < 0.02 * F.col("word1.n")), F.lit(False))
    limit = F.when(F.col("spike"), END_SHARE["spike"]).otherwise(END_SHARE["any"])
    bare = ~F.col("terminal")
    verdict = F.when(F.col("mark").isNotNull(), F.col("mark")).when(bare & F.coalesce("half", F.lit(False)), F.lit("word")).when(bare & F.col("spike") & (F.col("field") == "summary") & ~F.coalesce((share >= 0.6) & (F.col("best.k") >= 2), F.lit(False)), F.lit("limit")).when(bare & (((share < limit) & (F.col("best.k") > 0)) | leads), F.lit("phrase"))
    return out.select(*columns, "terminal", "spike", F.coalesce("half", F.lit(False)).alias("half"), share.alias("end_share"), F.col("best.n").alias("seen"), (F.col("best.k") + 1).alias("depth"), verdict.alias("cut"))


def truncation_rates(evidence: DataFrame) -> DataFrame:
    """By area and field: values, cut values, their share, and how many of them at a spike."""
    return evidence.groupBy("area", "field").agg(F.count("*").alias("n"), F.count("cut").alias("cut"), F.round(F.count("cut") / F.count("*"), 6).alias("rate"), F.count_if(F.col("cut").isNotNull() & F.col("spike")).alias("at_limit"))
