"""Variant spellings of names typed by people (problem 4).

Each typed name is read into a form: a core (surname, or the proper word of an organisation) and qualifiers (first name, middle initial; kind of
organisation and line of work). Nicknames and abbreviations are replaced through tables, misspelt first names by the nearest known one (Jaro-Winkler).

Blocking. Cores are the unit of comparison, so that a name held by many rows is compared once. The key of a core is the phonetic code of its tokens in
sorted order; a core is filed under its code and under the code with each one sign left out. One slip may change two signs of a code, so a core is also filed
under its spelling with signs left out (``spelling_keys``), which brings together all that ``same_core`` accepts. Cores that share a key are compared by
Jaro-Winkler and by edit distance. Forms of accepted cores are linked when their qualifiers agree. A form without a first name, or with an initial, is linked only if a single
fuller form agrees with it. Slugs, forms and links are clustered by connected components (alternating large-star and small-star, written after each round).

Nothing grows with the square of a group: equal forms are one node; the forms of a surname meet by the spellings of their first names, not all with all. First
names are counted, corrected and looked up by joins, whatever their number.

Defined results: null and blank names and slugs are left out; an alias counts as a name of its slug when it is a full name; names of one slug are one entity.
Names of which nothing is left but titles or kinds are not linked. Empty tables give no pairs. Names of any length are read whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import written

#: Short forms of first names. Fixed values.
NICKNAMES = {
    "alexandre": "alex sacha", "anne-sophie": "anso", "antoine": "toine", "augustin": "gus", "benjamin": "ben", "bertrand": "bebert", "catherine": "cathy kate",
    "christophe": "chris tophe", "dominique": "dom", "eduardo": "edu", "elisabeth": "lise babeth", "emmanuel": "manu", "francisco": "paco", "frederic": "fred",
    "friedrich": "fritz", "gabrielle": "gaby", "genevieve": "ginou", "giuseppe": "beppe", "isabelle": "isa zaza", "jacqueline": "jackie", "jean-baptiste": "jb",
    "josephine": "jo fifi", "katharina": "kathi", "madeleine": "mado", "margaret": "meg peggy maggie", "marie-claude": "marie-clo", "mathieu": "mat",
    "maximilien": "max", "nicolas": "nico", "olivier": "oli", "patricia": "pat patou", "philippe": "phil", "raphael": "raph", "robert": "bob rob", "rosalie": "rose",
    "sebastien": "seb bastien", "stephanie": "steph", "theodore": "theo", "thomas": "tom", "valerie": "val", "veronique": "vero", "william": "bill will",
}
TITLES = {"dr", "pr", "prof", "me", "ing", "mr", "mrs", "ms", "mme", "mlle", "herr", "frau", "sr", "sra", "maitre", "docteur", "professeur"}
PARTICLES = {"de", "du", "des", "le", "la", "van", "von", "der", "den", "d", "l", "da", "do", "di"}
#: Kinds of organisation with their short forms, lines of work with theirs, and legal forms. Fixed values.
ORG_KINDS = {
    "association": "asso", "bureau d'etudes": "be", "compagnie": "cie", "cooperative": "coop", "etablissements": "ets", "fondation": "fond", "groupe": "grp",
    "institut": "inst", "laboratoire": "labo", "societe": "ste",
}
ORG_WORK = {
    "conseil": "cons", "developpement": "dev", "energie": "ener", "environnement": "env", "industrie et services": "is", "informatique": "info", "logistique": "log",
    "maintenance": "maint", "systemes": "sys", "telecommunications": "telecoms",
}
LEGAL = {"ltd", "sarl", "sa", "sas", "gmbh", "inc", "ag", "spa", "srl", "lda", "llc", "snc"}
_FORMAL = {nick: full for full, nicks in NICKNAMES.items() for nick in nicks.split()}
#: Signs of a core from which its parts are its keys, as there would be too many ways to leave out two.
LONG = 40
_OCR = str.maketrans("01358", "oless")


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.casefold().replace("’", "'"))
    return re.sub(r"\s+", " ", "".join(c for c in s if not unicodedata.combining(c))).strip()


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity, prefix weight 0.1 over at most four signs."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    window = max(len(a), len(b)) // 2 - 1
    taken, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in range(len(b)) if taken[j]]
    m, t = len(hits), sum(x != y for x, y in zip(hits, other, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours; more than ``most`` is most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, prev = prev, row
    return prev[-1]


_SOUNDS = [(r"ph", "f"), (r"[ck]h|sch|sh", "S"), (r"qu|ck|[cqk]", "k"), (r"ge|j", "j"), (r"[sz]", "s"), (r"[vw]", "v"), (r"y", "i"), (r"(.)\1+", r"\1"), (r"[aeiouh]", "")]


def phonetic(token: str) -> str:
    """The consonant sounds of a token; a token of vowels is its own code."""
    t = token
    for a, b in _SOUNDS:
        t = re.sub(a, b, t)
    return t or token


def block_keys(core: str) -> list[str]:
    """The phonetic codes of the sorted tokens, whole and with each one sign left out."""
    code = "".join(phonetic(t) for t in sorted(core.split(" ")))
    return sorted({code, *(code[:i] + code[i + 1 :] for i in range(len(code)))} if len(code) > 3 else {code})


def same_core(a: str, b: str) -> bool:
    """May two cores be spellings of one? Close by Jaro-Winkler, and one slip apart (two in long ones)."""
    if a == b:
        return True
    x, y = a.replace(" ", ""), b.replace(" ", "")
    if x == y:
        return True
    short = min(len(x), len(y))
    near = jaro_winkler(x, y)
    if short < 5 or near < 0.82:
        return False
    return edits(x, y, 1) <= 1 or short >= 9 and near >= 0.92 and edits(x, y, 2) <= 2


def spelling_keys(core: str) -> list[str]:
    """Keys such that cores which ``same_core`` accepts share one: up to LONG signs the core without blanks and with one sign left out, or two where two slips
    are allowed; from there on its parts in five, as at least one of five is left whole by two slips and moves by two signs at most."""
    c = core.replace(" ", "")
    keys = {c}
    if 5 <= len(c) <= LONG + 2:
        keys |= {c[:i] + c[i + 1 :] for i in range(len(c))} if len(c) < 9 else set(without_two(c))
    if len(c) >= LONG:
        for n in range(len(c) - 2, len(c) + 3):
            for i in range(5):
                at, end = i * n // 5, (i + 1) * n // 5
                keys |= {f"{n}:{i}:{c[at + k : end + k]}" for k in range(-2, 3) if at + k >= 0 and end + k <= len(c)}
    return sorted(keys)


class FirstNames:
    """How tokens read as first names: token -> (the formal first name, how it is known: as it stands, glued together, or near one)."""

    def __init__(self, readings: Iterable[tuple[str, str, str]] = ()) -> None:
        self.readings = {t: (formal, how) for t, formal, how in readings}

    def known(self, token: str) -> bool:
        return self.readings.get(token, (None, ""))[1] == "known"

    def formal(self, token: str) -> str | None:
        """The first name that a token is: known as such, short for one, or close to one."""
        return self.readings.get(token, (None, ""))[0]

    def split(self, token: str) -> tuple[str, str] | None:
        """A first name and a surname written as one, or joined by a hyphen."""
        for i in range(len(token) - 4, 3, -1):
            if token[i] == "-" and (f := self.formal(token[:i])):
                return f, token[i + 1 :]
        for i in range(len(token) - 5, 4, -1):
            f, how = self.readings.get(token[:i], (None, ""))
            if f and how in ("known", "glued") and "-" not in token[:i]:
                return f, token[i:].lstrip("-")
        return None


_INITIAL = re.compile(r"[a-z](?:\.|-[a-z]\.?)?|a-s\.|m-c\.|j-b\.")


def _person_tokens(name: str) -> tuple[tuple[str, str] | None, list[str]]:
    """(initial and surname of a user name, or null; the tokens, first names first where a comma or bracket tells)."""
    s = fold(name)
    comma = re.match(r"([^,]+),\s*(.+)$", s)
    bracket = re.match(r"(.+?)\s*\((.+)\)\s*$", s)
    if comma:
        s = f"{comma[2]} {comma[1]}"
    elif bracket:
        s = f"{bracket[2]} {bracket[1]}"
    dotted = re.fullmatch(r"([a-z])\.([a-z][\w'-]+)", s)
    return ((dotted[1], dotted[2]) if dotted else None), s.replace(".", ". ").split()


def first_name_questions(name: str, longest: int) -> list[str]:
    """The tokens, and beginnings of a single one, whose reading as first names the reading of a person's name may ask for. No first name, and none that
    is near one, is longer than ``longest``."""
    dotted, tokens = _person_tokens(name)
    if dotted:
        return []
    words = [t.strip(".") for t in tokens if not _INITIAL.fullmatch(t)]
    core = [w for w in words if w and w not in PARTICLES and w not in TITLES]
    asks = {w for w in words if w}
    if len(core) == 1:
        asks |= {core[0][:i] for i in range(4, min(len(core[0]) - 3, longest + 1))}
    return sorted(w for w in asks if len(w) <= longest)


def read_person(name: str, firsts: FirstNames) -> tuple[str, str, str] | None:
    """(core, first name or initial or '', middle initial) of a person's name."""
    dotted, tokens = _person_tokens(name)
    if dotted:
        return dotted[1], dotted[0], ""
    tokens = [t for t in tokens if t.rstrip(".") not in TITLES or firsts.known(t.rstrip("."))]
    initials = [t for t in tokens if _INITIAL.fullmatch(t)]
    words = [t.strip(".") for t in tokens if t not in initials]
    core = [w for w in words if w not in PARTICLES and w]
    first, middle = "", ""
    if len(core) >= 2:
        forward, backward = firsts.formal(core[0]), firsts.formal(core[-1])
        exact = [firsts.known(c) for c in (core[0], core[-1])]
        if forward and (exact[0] or not exact[1]):
            first, core = forward, core[1:]
        elif backward:
            first, core = backward, core[:-1]
        else:
            first, core = core[0], core[1:]
    elif len(core) == 1:
        if parts := firsts.split(core[0]):
            first, core = parts[0], [parts[1]]
        elif firsts.known(core[0]):
            return None
    if initials:
        letter = initials[0][0]
        if first:
            middle = letter
        else:
            first = letter
    return (" ".join(sorted(core)), first, middle) if core and len("".join(core)) > 2 else None


def _qualifier(token: str, table: dict[str, str]) -> str | None:
    t = token.rstrip(".")
    for full, short in table.items():
        if t in (full, short) or len(t) >= 4 and (full.startswith(t) or jaro_winkler(t, full) >= 0.93):
            return full
    return None


def read_organisation(name: str) -> tuple[str, str, str] | None:
    """(core, kind or its letter or '', line of work or its letter or '') of an organisation's name."""
    s = fold(name).replace("&", "et").replace("s.a.r.l.", "sarl").replace("s.a.s.", "sas").replace("s.a.", "sa")
    s = re.sub(r"\bindustries? et services?\b", "industrie_et_services", s)
    s = re.sub(r"\bbureau d'? ?etudes?\b", "bureau_d'etudes", s)
    letters = re.match(r"([a-z])([a-z]s?)\. ?(?=[a-z])", s) if re.match(r"[A-ZÀ-Þ]{2,3}\. ?\S", name.strip()) else None
    kind = work = ""
    if letters:
        kind, work = letters[1], letters[2][0]
        s = s[letters.end() :]
    core = []
    for t in re.findall(r"[\w'.-]+", s):
        t = t.replace("_", " ")
        if t.rstrip(".") in LEGAL:
            continue
        if (k := _qualifier(t, ORG_KINDS)) and (not kind or kind == k[0]):
            kind = k
        elif (w := _qualifier(t, ORG_WORK)) and (not work or work == w[0]):
            work = w
        elif t.strip(".") and t not in PARTICLES:
            core.append(t.strip("."))
    return (" ".join(sorted(core)), kind, work) if core and len("".join(core)) > 2 else None


def agree(kind: str, a: tuple[str, str], b: tuple[str, str]) -> bool:
    """Do the qualifiers of two forms agree? A missing one agrees with all, an initial with what it begins."""
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if not x or not y or x == y:
            continue
        if len(x) == 1 or len(y) == 1:
            if x[0] != y[0]:
                return False
        elif kind == "personne" and i == 0 and jaro_winkler(x, y) >= 0.9 and edits(x, y, 2) <= 1 and x not in NICKNAMES and y not in NICKNAMES and not _gendered(x, y):
            continue
        else:
            return False
    return True


def _gendered(a: str, b: str) -> bool:
    """Are two first names one and the other with an ending? Such are different people."""
    a, b = sorted((a, b), key=len)
    return b.startswith(a) or a[:-1] == b[: len(a) - 1]


def _fullness(first: str) -> int:
    return 0 if not first else 1 if len(first) == 1 else 2


def _ask(longest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asks = [first_name_questions(n, longest) if k == "personne" else [] for k, n in zip(b.column("kind").to_pylist(), b.column("name").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(asks, pa.list_(pa.string()))], [*b.schema.names, "asks"])

    return run


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        forms = []
        for kind, name, told in zip(*(b.column(c).to_pylist() for c in ("kind", "name", "told")), strict=True):
            firsts = FirstNames((x["token"], x["formal"], x["how"]) for x in told or ())
            forms.append(read_person(name, firsts) if kind == "personne" else read_organisation(name))
        yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("name"), *[pa.array([f and f[i] for f in forms], pa.string()) for i in range(3)]], ["kind", "name", "core", "q1", "q2"])


def _accept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [same_core(x, y) for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)]
        yield b.filter(pa.array(ok, pa.bool_()))


def typed_names(envelope: DataFrame, kinds: tuple[str, ...] = ("personne", "organisation")) -> DataFrame:
    """(slug, kind, name, alias): names and aliases by slug, each once."""
    e = envelope.select(F.explode("entities").alias("e")).filter(F.col("e.subtype").isin(list(kinds)) & F.col("e.slug").isNotNull())
    own = e.select("e.slug", F.col("e.subtype").alias("kind"), F.col("e.name").alias("name"), F.lit(False).alias("alias"))
    more = e.select("e.slug", F.col("e.subtype").alias("kind"), F.explode("e.aliases").alias("name"), F.lit(True).alias("alias"))
    return own.unionByName(more).filter("trim(name) <> ''").distinct()


def _without_one(token: str) -> list[str]:
    """A token, and it with each one sign left out: two that are one slip apart share one of these."""
    return sorted({token, *(token[:i] + token[i + 1 :] for i in range(len(token)))})


def _keys(f: Callable[[str], list[str]], column: str) -> Column:
    """The hashes of the keys of a column's strings. Equal hashes only add pairs to compare."""
    return F.transform(F.pandas_udf(lambda c: c.map(f), "array<string>")(column), lambda x: F.xxhash64(x))


def known_first_names(names: DataFrame, *, least: int = 2, share: float = 2.0) -> DataFrame:
    """(first, n): the first names of the table, and the tokens that stand before at least ``least`` different surnames and more than ``share`` times as often
    first as last, whatever the number of names; rare ones one slip from a name twenty times as frequent are misspellings of it."""
    plain = X.fold(F.lower(F.trim(F.col("name"))))
    two = r"^([\p{L}-]{3,}) +([\p{L}-]{4,})$"
    pairs = names.filter("kind = 'personne'").select(F.regexp_extract(plain, two, 1).alias("first"), F.regexp_extract(plain, two, 2).alias("last")).filter("first <> ''").distinct()
    side = lambda c, f, z: F.struct(F.col(c).alias("first"), F.lit(f).alias("n"), F.lit(z).alias("z"))
    sides = pairs.select(F.explode(F.array(side("first", 1, 0), side("last", 0, 1))).alias("x")).groupBy("x.first").agg(F.sum("x.n").alias("n"), F.sum("x.z").alias("z"))
    spark = names.sparkSession
    table = spark.createDataFrame([(x,) for x in sorted({*NICKNAMES, *_FORMAL})], "first string").withColumn("fixed", F.lit(True))
    told = written(sides.join(table, "first", "full_outer").select("first", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("fixed", F.lit(False)).alias("fixed"), ((F.col("n") >= least) & (F.col("n") > share * F.col("z"))).alias("often")).filter("fixed or often"), "first-names")
    keyed = told.select("first", "n", "fixed", F.explode(_keys(_without_one, "first")).alias("key"))
    slip = F.pandas_udf(lambda a, b: pd.Series([edits(x, y, 1) <= 1 for x, y in zip(a, b, strict=True)], dtype=bool), "boolean")
    more = keyed.select(F.col("first").alias("other"), F.col("n").alias("more"), "key")
    wrong = keyed.filter("not fixed").join(more, "key").filter((F.col("more") > 20 * F.col("n")) & (F.col("first") != F.col("other"))).select("first", "other").distinct().filter(slip("first", "other"))
    return written(told.filter("fixed or length(first) > 2").join(wrong.select("first"), "first", "left_anti").select("first", "n"), "known-first-names")


def _nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, first, near): the likeness by Jaro-Winkler, where that and the edit distance allow it."""
    for b in batches:
        out = []
        for token, t, k in zip(*(b.column(c).to_pylist() for c in ("token", "t", "first")), strict=True):
            near = jaro_winkler(t, k)
            if near >= 0.9 and edits(t, k, 2) <= (1 if len(t) < 6 else 2):
                out.append((token, k, near))
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64())], ["token", "first", "near"])


def first_name_readings(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """(token, formal, how) of the different ``tokens`` that read as first names: known ones, those written together or with a hyphen, and the nearest
    one by Jaro-Winkler among those within two slips, which share a spelling with one or two signs left out. All by joins; nothing is collected."""
    formal = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(_FORMAL.items()) for x in kv]), F.col("first")), F.col("first"))
    as_known = tokens.join(known.select(F.col("first").alias("token"), formal.alias("formal")), "token").withColumn("how", F.lit("known"))
    bare = F.replace(F.col("first"), F.lit("-"), F.lit(""))
    joined = known.filter("length(first) >= 4").groupBy(bare.alias("bare")).agg(F.min("first").alias("first")).select("bare", formal.alias("formal"))
    rest = tokens.join(known.select(F.col("first").alias("token")), "token", "left_anti")
    as_glued = rest.filter("length(token) > 4").withColumn("bare", F.replace("token", F.lit("-"), F.lit(""))).join(joined, "bare").select("token", "formal", F.lit("glued").alias("how"))
    rest = rest.filter("length(token) >= 4").join(as_glued.select("token"), "token", "left_anti").withColumn("t", F.translate("token", "01358", "oless"))
    filed = known.filter("length(first) > 3").select("first", F.explode(_keys(without_two, "first")).alias("key"))
    met = rest.select("token", "t", F.explode(_keys(without_two, "t")).alias("key")).join(filed, "key").select("token", "t", "first").distinct()
    as_near = met.mapInArrow(_nearest, "token string, first string, near double").groupBy("token").agg(F.max_by("first", F.struct("near", "first")).alias("first")).select("token", formal.alias("formal"), F.lit("near").alias("how"))
    return as_known.unionByName(as_glued).unionByName(as_near)


def read_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """(slug, kind, name, alias, core, q1, q2): each typed name with its form. Every different name is read once."""
    longest = (known.agg(F.max(F.length("first"))).first()[0] or 0) + 2
    asked = written(names.select("kind", "name").distinct().mapInArrow(_ask(longest), "kind string, name string, asks array<string>"), "asked")
    each = asked.select("kind", "name", F.explode("asks").alias("token"))
    found = written(first_name_readings(written(each.select("token").distinct(), "tokens"), known), "readings")
    told = each.join(found, "token").groupBy("kind", "name").agg(F.collect_list(F.struct("token", "formal", "how")).alias("told"))
    forms = asked.select("kind", "name").join(told, ["kind", "name"], "left").mapInArrow(_read, "kind string, name string, core string, q1 string, q2 string").filter("core is not null")
    return names.join(forms, ["kind", "name"])


def connected_components(edges: DataFrame, *, rounds: int | None = None) -> DataFrame:
    """(node, component): the smallest node of its component for each node of the edges (a, b). Alternates large-star and small-star; each round is written
    and reads the one before, and the loop ends when a round changes nothing; where ``rounds`` are not enough for that, it is an error."""
    e = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    done = 0
    while True:
        if done == rounds:
            raise RuntimeError(f"components still change after {rounds} rounds")
        done += 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        e = written(small, "edges")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == before:
            break
        before = (state["n"], state["s"])
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()


def without_two(core: str) -> list[str]:
    """A core without blanks, and with one or two of its signs left out: cores two slips apart share one of these."""
    c = core.replace(" ", "")
    one = {c[:i] + c[i + 1 :] for i in range(len(c))}
    return sorted({c, *one, *(x[:i] + x[i + 1 :] for x in one for i in range(len(x)))})


def core_pairs(cores: DataFrame, *, most: int | None = 400) -> DataFrame:
    """(kind, a, b): cores that share a block (kind, key, core). A block of more than ``most`` cores is divided by the keys of
    their spellings, so that all pairs that ``same_core`` can accept still meet."""
    sizes = cores.groupBy("kind", "key").agg(F.count("*").alias("n")).filter(F.col("n") > (most or 0))
    if most and sizes.limit(1).count():
        sizes = written(sizes.select("kind", "key"), "large-blocks")
        spread = F.pandas_udf(lambda c: c.map(spelling_keys), "array<string>")
        large = cores.join(sizes, ["kind", "key"]).select("kind", F.explode(spread("core")).alias("rest"), "key", "core")
        cores = cores.join(sizes, ["kind", "key"], "left_anti").unionByName(large.select("kind", F.concat_ws("\x1f", "key", "rest").alias("key"), "core"))
    a, b = (cores.select("kind", "key", F.col("core").alias(n)) for n in ("a", "b"))
    return a.join(b, ["kind", "key"]).filter("a < b").select("kind", "a", "b").distinct()


def _agree_udf():
    @F.pandas_udf("boolean")
    def f(kind, a1, a2, b1, b2):  # noqa: ANN001, ANN202
        return pd.Series([agree(k, (w, x), (y, z)) for k, w, x, y, z in zip(kind, a1, a2, b1, b2, strict=True)])

    return f


def agreeing_forms(forms: DataFrame, near: DataFrame) -> DataFrame:
    """(kind, a, p1, p2, b, q1, q2): pairs of different forms of cores that are near each other (kind, a, b) whose qualifiers agree: full first names
    with full ones, partial forms with all others. Full first names meet by their spelling with one sign left out, so a surname that many people share
    costs no pair of them; partial forms, like kinds and lines of work, are few for each core."""
    left = forms.select("kind", F.col("core").alias("a"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).join(near, ["kind", "a"])
    right = forms.select("kind", F.col("core").alias("b"), "q1", "q2")
    person = F.col("kind") == "personne"
    spell = lambda df, c: df.filter(person & (F.length(c) > 1)).withColumn("key", F.explode(_keys(_without_one, c)))
    people = spell(left, "p1").join(spell(right, "q1"), ["kind", "b", "key"]).drop("key").distinct()
    partial = left.filter(person & (F.length("p1") <= 1)).join(right, ["kind", "b"])
    others = left.filter(~person).join(right.filter(~person), ["kind", "b"])
    met = people.unionByName(partial).unionByName(others).filter(~((F.col("a") == F.col("b")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2"))))
    return met.filter((F.col("p1") == "") | (F.col("q1") == "") | (F.left("p1", F.lit(1)) == F.left("q1", F.lit(1)))).filter(_agree_udf()("kind", "p1", "p2", "q1", "q2"))


def link_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """(slug, component): the slugs of names typed for the same person or organisation share a component. ``known``: the first names (first, n)."""
    read = read_names(names, known)
    # An alias that is no full name says nothing by itself.
    read = read.filter(~F.col("alias") | ((F.length("q1") > 1) & ((F.col("kind") == "personne") | (F.col("q2") != "") | (F.col("q1") != ""))))
    read = written(read, "names")
    form = F.concat_ws("\x1f", "kind", "core", "q1", "q2")
    forms = written(read.select("kind", "core", "q1", "q2").distinct(), "forms")
    one = forms.select("kind", "core").distinct()
    filed = lambda f, name: written(one.select("kind", F.explode(F.pandas_udf(lambda c: c.map(f), "array<string>")("core")).alias("key"), "core"), name)
    # Hashes that happen to be equal only add pairs to compare. Blocks of spellings are not divided: what would divide them is their key.
    spelled = filed(spelling_keys, "spellings").withColumn("key", F.xxhash64("key"))
    pairs = core_pairs(filed(block_keys, "blocks")).unionByName(core_pairs(spelled, most=None)).distinct()
    close = written(pairs.mapInArrow(_accept, "kind string, a string, b string"), "cores")
    near = close.unionByName(close.select("kind", F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(forms.select("kind", F.col("core").alias("a"), F.col("core").alias("b")).distinct())
    met = agreeing_forms(forms, near)
    x, y = F.concat_ws("\x1f", "kind", "a", "p1", "p2"), F.concat_ws("\x1f", "kind", "b", "q1", "q2")
    met = written(met.select(x.alias("x"), y.alias("y"), "kind", "a", "b", "p1", "q1", "p2", "q2"), "agreeing")
    full = lambda c: F.length(c) > 1
    equal = met.filter(full("p1") & full("q1")).filter("kind = 'personne' or (p2 <> '' and q2 <> '' and length(p2) > 1 and length(q2) > 1)").select("x", "y")
    # A partial form goes with the fuller ones that agree with it, if these are one person or organisation.
    partial = met.filter("length(p1) <= 1 or (kind <> 'personne' and length(p2) <= 1)").filter((full("q1") & ((F.col("kind") == "personne") | full("q2"))))
    whose = F.when(F.col("kind") == "personne", F.col("q1")).otherwise(F.concat_ws("\x1f", "q1", "q2"))
    who = partial.withColumn("who", whose).withColumn("exact", F.col("a") == F.col("b"))
    groups = who.groupBy("x").agg(F.count_distinct("who").alias("n"), F.count_distinct(F.when(F.col("exact"), F.col("who"))).alias("n_exact"))
    kept = who.join(groups, "x").filter("n = 1 or (n_exact = 1 and exact)").select("x", "y")
    # Partial forms without any fuller one still go with equal cores and agreeing qualifiers.
    alone = met.join(groups.select("x"), "x", "left_anti").join(groups.select(F.col("x").alias("y")), "y", "left_anti").filter("length(p1) <= 1 or (kind <> 'personne' and (length(p2) <= 1 or length(q1) <= 1))").filter(~(full("q1") & ((F.col("kind") == "personne") | full("q2")))).select("x", "y")
    owned = read.select(F.concat(F.lit("s\x1f"), "slug").alias("a"), F.concat(F.lit("f\x1f"), form).alias("b"))
    linked = equal.unionByName(kept).unionByName(alone).select(F.concat(F.lit("f\x1f"), "x").alias("a"), F.concat(F.lit("f\x1f"), "y").alias("b"))
    parts = connected_components(owned.unionByName(linked))
    return parts.filter("node like 's\x1f%'").select(F.substring("node", 3, 1 << 30).alias("slug"), "component")


def slug_pairs(linked: DataFrame) -> DataFrame:
    """(slug_a, slug_b): each pair of slugs of a component, the smaller first. Components are the spellings of one name."""
    a, b = (linked.select("component", F.col("slug").alias(n)) for n in ("slug_a", "slug_b"))
    return a.join(b, "component").filter("slug_a < slug_b").select("slug_a", "slug_b")
