"""Missing or wrong language labels (problem 2), by rank-order n-gram profiles.

Training. Sentences in which the common words of one language clearly outweigh those of the others count for that language. Their n-grams (one to
``MAX_N`` characters, words padded with blanks) are counted over all texts; the ``PROFILE_SIZE`` most frequent of each language, by rank, are its profile.
Profiles are bounded (languages x size) and are all that is collected or sent to the executors.

Assignment. A text is cut into sentences; names, quoted phrases, links and numbers are set aside, as they say nothing of the language around them. The
n-grams of a sentence, ranked by frequency, are compared with each profile by the out-of-place distance (the sum of the differences of rank; a missing
n-gram costs the profile's size). The nearest language wins; the confidence is the margin to the second as a share of its distance. An exact check
follows where the margin is small: whole words known in one language only decide. A fragment with too little to go by takes the language of the sentence
beside it. Neighbouring sentences of one language make a segment; the text's own language is that of most of its characters.

Defined results: null, empty and blank texts, and texts without a letter, give no segment. Texts of any length are used whole. Equal rows are each labelled.
Without any training text the profiles hold the common words alone.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

LANGUAGES = ("de", "en", "es", "fr", "it", "pt")
PROFILE_SIZE, MAX_N = 1500, 5
#: Letters below which a fragment that follows or precedes a sentence is not judged by itself, and the margin below which words decide.
FEW_LETTERS, SMALL_MARGIN = 7, 0.25
#: The letters and the margin at which a shorter fragment is judged all the same.
FEWER_LETTERS, LARGE_MARGIN = 4, 0.3

#: Names of the six languages in codes, in the language itself and in English. Fixed values.
NAMES = {
    "de": ("de", "deu", "ger", "deutsch", "german"),
    "en": ("en", "eng", "english", "anglais"),
    "es": ("es", "spa", "esp", "español", "espanol", "castellano", "spanish"),
    "fr": ("fr", "fra", "fre", "français", "francais", "french"),
    "it": ("it", "ita", "italiano", "italian"),
    "pt": ("pt", "por", "português", "portugues", "portuguese"),
}

_QUOTED = re.compile(r"«[^»\n]*(?:»|$)|“[^”\n]*(?:”|$)|„[^“”\n]*(?:[“”]|$)|\"[^\"\n]*(?:\"|$)|`[^`\n]*(?:`|$)|\[\[[^\]\n]*(?:\]\]|$)|\{\{[^}\n]*(?:\}\}|$)|https?://\S+|&#?\w*;?")
_BREAK = re.compile(r"(?<=[.?!…])(?<!\b[A-ZÀ-Þ]\.)(?<!\b(?:Dr|Pr|Me)\.)(?<!\b(?:Ing|Mme|Ste|Cie|Grp|Ets|Sys|Log|Env|Ref)\.)(?<!\b(?:Inst|Asso|Fond|Labo|Coop)\.)\s+|[\r\n]+|\s+[/|•—–]\s+|^\s*[/—–-]\s+")
_WORD = re.compile(r"[^\W\d_]+")


def label_language(label: Column) -> Column:
    """The language that a label names, or null. A code may carry a region."""
    bare = F.lower(F.trim(label))
    base = F.regexp_extract(bare, r"^([a-z]{2,3})[-_](?:[a-z]{2}|\d{3})$", 1)
    out = F.lit(None).cast("string")
    for lang, names in NAMES.items():
        codes = [n for n in names if len(n) <= 3]
        out = F.when(bare.isin(list(names)) | base.isin(codes), F.lit(lang)).otherwise(out)
    return out


def split_sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence."""
    cuts, at = [], 0
    for m in _BREAK.finditer(text):
        cuts.append((at, m.start()))
        at = m.end()
    cuts.append((at, len(text)))
    return [(a, b) for a, b in cuts if text[a:b].strip()]


def _plain(s: str) -> str:
    s = s.casefold()
    return s if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


class _Kept(dict):
    """What a function gives for a word, worked out once each."""

    def __init__(self, f: Callable[[str], object]) -> None:
        self.f = f

    def __missing__(self, word: str) -> object:
        if len(self) > 1 << 17:
            self.clear()
        self[word] = x = self.f(word)
        return x


_PLAIN = _Kept(_plain)


def content_words(sentence: str) -> list[str]:
    """The words that tell the language, folded: without quotations, links, names and a word that the end cuts off."""
    s = _QUOTED.sub(" ", sentence)
    words = _WORD.findall(s)
    if s.upper() == s:
        return [_PLAIN[w] for w in words]
    return [_PLAIN[w] for w in words[:1]] + [_PLAIN[w] for w in words[1:] if not w[0].isupper()]


def _word_grams(w: str) -> list[str]:
    p = f" {w} "
    return [g for n in range(1, MAX_N + 1) for i in range(len(p) - n + 1) if (g := p[i : i + n]) != " "]


_GRAMS = _Kept(_word_grams)


def grams(words: Iterable[str]) -> Counter[str]:
    """Counts of the n-grams of the words, padded with blanks."""
    return Counter(chain.from_iterable(map(_GRAMS.__getitem__, words)))


class Seeds:
    """Common words by language; a word counts the less the more languages have it."""

    def __init__(self, rows: Iterable[tuple[str, str]]) -> None:
        langs: dict[str, set[str]] = {}
        for lang, word in rows:
            if lang in LANGUAGES and word:
                langs.setdefault(_plain(word), set()).add(lang)
        self.weights = {w: {x: 1 / len(ls) ** 2 for x in ls} for w, ls in langs.items()}

    def sure(self, words: list[str]) -> str | None:
        """The language whose common words clearly outweigh the others'."""
        scores: dict[str, float] = {}
        for known in filter(None, map(self.weights.get, words)):
            for lang, x in known.items():
                scores[lang] = scores.get(lang, 0.0) + x
        top = sorted(scores.values(), reverse=True)
        if not top or top[0] < 1.5 or len(top) > 1 and top[0] < 1.6 * top[1]:
            return None
        return max(scores, key=scores.__getitem__)


#: Everyday words of short notes, beside the table of common words. Fixed values.
EVERYDAY = {
    "de": "nichts nicht heute morgen gestern keine weiteren wurde worden diese dieser dieses jetzt erledigt siehe gibt bitte alle alles",
    "en": "nothing today tomorrow yesterday taken done see report new made further action week page please will should out up",
    "es": "nada hoy mañana ayer ninguna ninguno tomó hecho véase ver nuevo novedades medida semana página también todo todos",
    "fr": "rien aujourd hui demain hier aucune aucun suite voir signaler fait nouveau semaine page tout tous objet lundi",
    "it": "niente oggi domani ieri nessuna nessuno segnalare fatto vedi nuovo novità settimana pagina tutto tutti anche ancora",
    "pt": "nada hoje amanhã ontem nenhuma nenhum assinalar feito ver novo novidades semana página tudo todos também houve",
}


class Profiles:
    """Rank-order profiles and the words known in each language."""

    def __init__(self, ranks: dict[str, dict[str, int]], words: dict[str, dict[str, float]]) -> None:
        self.ranks, self.words = ranks, words
        self.languages = list(ranks)
        self.rows = {g: i for i, g in enumerate(sorted({g for r in ranks.values() for g in r}))}
        #: table[i, l]: the rank of the i-th n-gram in the l-th language; what a profile lacks, and the last row, is further off than any rank.
        self.table = np.full((len(self.rows) + 1, len(ranks)), 1 << 40, np.int64)
        for at, r in enumerate(ranks.values()):
            self.table[[self.rows[g] for g in r], at] = list(r.values())

    def distances(self, words: list[str]) -> dict[str, float]:
        """Out-of-place distance to each language, as a share of the greatest possible."""
        n = grams(words)
        if not n:
            return {}
        ranked = sorted(n)
        ranked.sort(key=n.__getitem__, reverse=True)  # equal counts stay in the order of the n-grams
        unknown, far = len(self.rows), PROFILE_SIZE
        place = self.table[[self.rows.get(g, unknown) for g in ranked]] - np.arange(len(ranked))[:, None]
        apart = np.minimum(np.abs(place), far).sum(axis=0)
        return {lang: int(x) / (far * len(ranked)) for lang, x in zip(self.languages, apart, strict=True)}

    def judge(self, sentence: str) -> tuple[str | None, float, int]:
        """(language, confidence, letters that it rests on)."""
        words = content_words(sentence)
        letters = sum(map(len, words))
        d = sorted((x, lang) for lang, x in self.distances(words).items())
        if not d:
            return None, 0.0, 0
        if len(d) < 2:
            return d[0][1], 1.0, letters
        margin = (d[1][0] - d[0][0]) / max(d[1][0], 1e-9)
        best = d[0][1]
        known: Counter[str] = Counter()
        for w in words:
            for lang, share in self.words.get(w, {}).items():
                known[lang] += share * share  # words of one language count most
        if known and margin < SMALL_MARGIN:
            top = known.most_common(2)
            second = top[1][1] if len(top) > 1 else 0.0
            if top[0][1] >= 0.8 and top[0][1] > 1.3 * second:
                apart = (top[0][1] - second) / (top[0][1] + second) / 2
                best, margin = top[0][0], max(margin, apart) if top[0][0] == best else apart
        return best, margin, letters

    def segments(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, language, confidence) of each stretch in one language."""
        found = [(a, b, *self.judge(text[a:b])) for a, b in split_sentences(text)]
        sure = [i for i, f in enumerate(found) if f[2] and f[3] > 0 and (f[4] >= FEW_LETTERS or f[4] >= FEWER_LETTERS and f[3] >= LARGE_MARGIN)]
        if not sure:
            sure = [i for i, f in enumerate(found) if f[2]][:1]
        if not sure:
            return []
        out: list[list] = []
        at = 0  # the first sure sentence that is not before this one
        for i, (a, b, lang, conf, letters) in enumerate(found):
            while at < len(sure) and sure[at] < i:
                at += 1
            if at == len(sure) or sure[at] != i:
                near = min(sure[max(0, at - 1) : at + 1], key=lambda j: (abs(j - i), j > i))
                lang, conf, letters = found[near][2], 0.0, 0
            if out and out[-1][2] == lang:
                out[-1][1] = b
                out[-1][3] += conf * letters
                out[-1][4] += letters
            else:
                out.append([a, b, lang, conf * letters, letters])
        return [(a, b, lang, round(c / max(n, 1), 6)) for a, b, lang, c, n in out]


def _train(seeds: Seeds):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: Counter[tuple[str, str]] = Counter()
            for text in b.column(0).to_pylist():
                for a, z in split_sentences(text or ""):
                    words = content_words(text[a:z])
                    if lang := seeds.sure(words):
                        n.update((lang, w) for w in words)
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in n], pa.string()) for i in range(2)] + [pa.array(list(n.values()), pa.int64())], ["lang", "item", "n"])

    return run


def _cut_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, item, n): the words themselves and their n-grams."""
    for b in batches:
        n: Counter[tuple[str, str, str]] = Counter()
        for lang, w, k in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            n[lang, "word", w] += k
            for g in _GRAMS[w]:
                n[lang, "gram", g] += k
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in n], pa.string()) for i in range(3)] + [pa.array(list(n.values()), pa.int64())], ["lang", "kind", "item", "n"])


def most_frequent(counted: DataFrame, group: list[str], most: Column, *, buckets: int = 64) -> DataFrame:
    """The ``most`` rows of each group by ``n``, equal ones by ``item``, with their place ``r``. First within buckets of hash space, then among what these
    leave, so that no task sorts a whole group."""
    order = [F.desc("n"), "item"]
    first = counted.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
    first = first.withColumn("r", F.row_number().over(Window.partitionBy(*group, "bucket").orderBy(*order))).filter(F.col("r") <= most).drop("bucket", "r")
    return first.withColumn("r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("r") <= most)


def train_profiles(texts: DataFrame, text: Column, common_words: DataFrame, *, size: int = PROFILE_SIZE, words: int = 3000) -> Profiles:
    """Profiles learnt from all the texts. ``words``: so many most frequent words of each language are kept for the exact check."""
    rows = common_words.select("lang", "word").filter(F.col("lang").isin(list(LANGUAGES))).distinct().collect()  # the fixed table of common words
    seeds = Seeds([*((r.lang, r.word) for r in rows), *((x, w) for x, ws in EVERYDAY.items() for w in ws.split())])
    # Words are summed up first: each is cut into n-grams once, not once a batch.
    seen = texts.select(text.alias("text")).mapInArrow(_train(seeds), "lang string, item string, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    counted = seen.mapInArrow(_cut_grams, "lang string, kind string, item string, n bigint").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    top = most_frequent(counted, ["lang", "kind"], F.when(F.col("kind") == "gram", size).otherwise(words)).toPandas()
    ranks: dict[str, dict[str, int]] = {x: {} for x in LANGUAGES}
    share: dict[str, dict[str, float]] = {}
    totals = top[top.kind == "word"].groupby("lang").n.sum().to_dict()
    for r in top.itertuples():
        if r.kind == "gram":
            ranks[r.lang][r.item] = r.r - 1
        elif r.n >= 2:
            share.setdefault(r.item, {})[r.lang] = r.n / totals[r.lang]
    for x, seen in ranks.items():
        if not seen:
            own = grams(wd for wd, ls in seeds.weights.items() if x in ls)
            seen.update((g, i) for i, (g, _) in enumerate(sorted(own.items(), key=lambda p: (-p[1], p[0]))[:size]))
    for wd, ls in seeds.weights.items():
        for x in ls:
            share.setdefault(wd, {}).setdefault(x, 1e-4)
    known = {wd: {x: v / sum(ls.values()) for x, v in ls.items()} for wd, ls in share.items()}
    return Profiles(ranks, known)


def _label(profiles: Profiles):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())]))
        for b in batches:
            out = [[dict(zip(("start", "end", "lang", "confidence"), s, strict=True)) for s in profiles.segments(t or "")] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, kind)], ["row", "segments"])

    return run


def language_segments(df: DataFrame, text: Column, profiles: Profiles, into: str = "segments") -> DataFrame:
    """``df`` with the array column ``into`` of (start, end, lang, confidence); offsets are in code points, the end excluded."""
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), text.cast("string").alias("text"))
    part = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType())])
    schema = T.StructType([row.schema["row"], T.StructField("segments", T.ArrayType(part))])
    out = row.mapInArrow(_label(profiles), schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns], F.col("segments").alias(into))


def main_language(segments: Column) -> Column:
    """struct(lang, confidence) of the language of most characters, the first where two have as many; null without segments."""
    langs = F.array_distinct(F.transform(segments, lambda s: s.lang))
    size = lambda x: F.aggregate(F.filter(segments, lambda s: s.lang == x), F.lit(0), lambda a, s: a + s.end - s.start)
    mean = lambda x: F.aggregate(F.filter(segments, lambda s: s.lang == x), F.lit(0.0), lambda a, s: a + s.confidence * (s.end - s.start)) / F.greatest(size(x), F.lit(1))
    ranked = F.array_sort(F.transform(langs, lambda x, i: F.struct((-size(x)).alias("a"), i.alias("b"), x.alias("lang"), F.round(mean(x), 6).alias("confidence"))))
    best = F.try_element_at(ranked, F.lit(1))
    return F.when(best.isNotNull(), F.struct(best.lang.alias("lang"), best.confidence.alias("confidence")))


def envelope_summaries(envelope: DataFrame) -> DataFrame:
    """(sha256, chunk_idx, label, summary), rows delivered twice once."""
    return envelope.select(F.col("source.sha256").alias("sha256"), F.col("source.chunk.idx").cast("int").alias("chunk_idx"), F.col("extraction.language").alias("label"), F.col("note.summary").alias("summary")).filter("trim(summary) <> ''").distinct()


def envelope_texts(envelope: DataFrame) -> DataFrame:
    """(text): summaries and sections, to learn from."""
    return envelope.select(F.explode(F.concat(F.array("note.summary"), F.coalesce("note.sections.markdown", F.array()))).alias("text")).filter("text is not null")


def unnamed_languages(segmented: DataFrame) -> DataFrame:
    """(sha256, chunk_idx, lang): each language of a summary that its label does not name."""
    each = segmented.select("sha256", "chunk_idx", label_language(F.col("label")).alias("named"), F.explode(F.array_distinct(F.transform("segments", lambda s: s.lang))).alias("lang"))
    return each.filter(~F.col("lang").eqNullSafe(F.col("named"))).select("sha256", "chunk_idx", "lang").distinct()
