"""The quality rules over pages, links, index and ledger. Each takes DataFrames and gives findings (severity, rule, location, observed); a set of findings is a bag.

Pages: sub, name, stem, text, fm, body, prose, err, and ``dir_ord`` made here; ``err`` marks unreadable front matter. Rules that look at one page alone are one projection
(``page_findings``); link rules are semi and anti joins by key. Links are taken from the prose, per occurrence. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..session import in_order

SEVERITIES = ("CRITIQUE", "MAJEUR", "MINEUR", "INFO")
FOLDERS = ("sources", "entities", "concepts")
#: Least characters of a body by folder, and keys that front matter must have. Fixed values.
LEAST_BODY = {"sources": 200, "entities": 120, "concepts": 120}
REQUIRED = {"sources": ("title", "type", "tags", "last_updated"), "entities": ("tags",), "concepts": ("tags",)}
FRENCH_KEYS = ("titre", "resume", "resume_", "type_", "cree_le", "etiquettes", "fichier_source")
DATE_KEYS = ("last_updated", "date_added", "created_at")
TYPES = {"sources": ("source", "source-summary"), "entities": ("entity",), "concepts": ("concept",)}
#: Signs of instructions smuggled into a page. Fixed values.
INJECTIONS = (
    r"ignore\s+(the\s+)?(previous|above|prior)",
    r"disregard\s+(the\s+)?(previous|above|all)",
    r"(ignore|oublie|remplace)[^.\n]{0,20}(ton|le|the)\s+system\s+prompt",
    r"tu\s+dois\s+ex[eé]cuter",
    r"run\s+the\s+following",
    r"curl\s+[^\s]+\s*\|\s*(ba)?sh",
    r"rm\s+-rf\s+/",
    r"<(?:script|iframe)[^>]{0,200}src\s*=\s*[\"']?(?:http://|//)?\d{1,3}(?:\.\d{1,3}){3}",
    r"<(?:script|iframe)[^>]{0,200}src\s*=\s*[\"']?javascript:",
    r"\bjavascript:\s*(?:eval|fetch|document\.cookie)",
)


def live_pages(page: DataFrame) -> DataFrame:
    """Pages that are not deleted."""
    return page.filter("deleted_at is null")


def _at(p: str = "") -> Column:
    return F.concat(F.lit("wiki/"), F.col(p + "sub"), F.lit("/"), F.col(p + "name"))


def _find(df: DataFrame, severity: str | Column, rule: str, observed: Column, location: Column | None = None) -> DataFrame:
    s = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(s.alias("severity"), F.lit(rule).alias("rule"), (_at() if location is None else location).alias("location"), observed.cast("string").alias("observed"))


def _fm(key: str) -> Column:
    return F.try_element_at("fm", F.lit(key))


def _stub() -> Column:
    return F.lower(F.regexp_replace(X.strip(F.coalesce(_fm("stub"), F.lit(""))), '^"+|"+$', "")) == "true"


def _ok(pages: DataFrame) -> DataFrame:
    return pages.filter("err is null and fm is not null")


def _first_of_stem(pages: DataFrame) -> DataFrame:
    """(stem, sub, name, fm, any_stub, n): the first page of each stem, by folder and name."""
    place = page_order()
    return pages.groupBy("stem").agg(F.min_by(F.struct("sub", "name", "fm"), place).alias("p"), F.max(F.coalesce(_stub(), F.lit(False))).alias("any_stub"), F.count("*").alias("n")).select("stem", "p.*", "any_stub", "n")


def page_links(pages: DataFrame) -> DataFrame:
    """(sub, name, target): the wikilinks of the prose, per occurrence."""
    return pages.filter("body is not null").select("sub", "name", F.explode(X.wikilinks(F.coalesce("prose", "body"))).alias("target"))


def told_links(pages: DataFrame) -> DataFrame:
    """(sub, name, target, n): the links with the number of pages that their target names; null without one. All link rules read this one join."""
    return page_links(pages).join(pages.groupBy(F.col("stem").alias("target")).agg(F.count("*").alias("n")), "target", "left").select("sub", "name", "target", "n")


def page_order() -> Column:
    """The place of a page: by folder, then by name."""
    return F.struct(F.array_position(F.array(*map(F.lit, FOLDERS)), F.col("sub")).alias("o"), F.col("name").alias("n"))


def _floor() -> Column:
    out = F.lit(200)
    for s, n in LEAST_BODY.items():
        out = F.when(F.col("sub") == s, n).otherwise(out)
    return F.when(F.left("body", F.lit(300)).rlike(r"(?m)page fusionn|^Voir \[\[.{1,80}\]\]"), 0).otherwise(out)


def _item(severity: str | Column, observed: Column, location: Column | None = None) -> Column:
    s = F.lit(severity) if isinstance(severity, str) else severity
    return F.struct(s.alias("severity"), observed.cast("string").alias("observed"), (_at() if location is None else location).alias("location"))


def _if(cond: Column, *item: object) -> Column:
    return F.array_compact(F.array(F.when(cond, _item(*item))))


def _injections() -> Column:
    """The first match of each sign of injection in ``scan``, with its line in the file."""
    head = F.left("text", F.length("text") - F.length("body"))
    offset = F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit("")))
    hit = lambda r: F.struct(F.regexp_instr("scan", F.lit(f"(?i){r}")).alias("at"), F.left(F.regexp_extract("scan", f"(?i)({r})", 1), F.lit(60)).alias("what"))
    found = F.filter(F.array(*map(hit, INJECTIONS)), lambda h: h["at"] > 0)
    return F.transform(found, lambda h: _item("CRITIQUE", h["what"], F.concat_ws(":", _at(), (X.line_of(F.col("scan"), h["at"]) + offset).cast("string"))))


def _page_rules(today: Column) -> dict[str, Column]:
    """Of each rule that looks at one page alone, the array of what it finds there: severity, observed, location."""
    ok = F.col("err").isNull() & F.col("fm").isNotNull()
    n, floor, name = F.col("_n"), F.col("_floor"), F.col("name")
    lacks = lambda k: F.coalesce(_fm(k), F.lit("")) == ""
    required = [F.when(ok & F.col("sub").isin([s for s, ks in REQUIRED.items() if k in ks]) & lacks(k), _item("MAJEUR", F.lit(k))) for k in ("title", "type", "tags", "last_updated")]
    fits = reduce(lambda a, b: a | b, [(F.col("sub") == s) & _fm("type").isin(*t) for s, t in TYPES.items()])
    dated = F.transform(F.array(*[F.struct(F.lit(k).alias("k"), D.date_problem(_fm(k), today).alias("p")) for k in DATE_KEYS]), lambda d: F.when(d.p.isNotNull(), _item("MAJEUR", F.concat_ws(":", d.k, d.p))))
    none = F.array().cast("array<struct<severity:string,observed:string,location:string>>")
    return {
        "R5": _if(F.col("body").isNotNull() & ~F.coalesce("prose", "body").rlike(X.WIKILINK), "MINEUR", F.lit("0")),
        "R7": _if(~name.rlike(r"^[a-z0-9][a-z0-9._-]*\.md$"), "INFO", F.when(name.rlike(r"^-[a-z0-9._-]*\.md$"), F.lit("dash")).otherwise(F.lit("other"))),
        "R8": _if(F.col("err").isNotNull() | F.col("text").isNull(), "CRITIQUE", F.coalesce("err", F.lit("unreadable"))),
        "R9": F.array_compact(F.array(*required, F.when(ok & (F.col("sub") != "sources") & lacks("title"), _item("INFO", F.lit("title"))))),
        "R10": F.when(ok, F.transform(F.array_intersect(F.map_keys("fm"), F.array(*map(F.lit, FRENCH_KEYS))), lambda k: _item("MINEUR", k))).otherwise(none),
        "R11": _if(ok & ~lacks("type") & ~fits, "MAJEUR", _fm("type")),
        "R12": F.when(ok, F.array_compact(dated)).otherwise(none),
        "R14": _if(ok & ~_stub() & (floor > 0) & ((n < floor) | ~F.col("body").rlike("(?m)^#")), "MAJEUR", F.when(n < floor, n.cast("string")).otherwise(F.lit("no heading"))),
        "R17": _if(ok & ~_stub() & (n >= F.greatest(floor, F.lit(200))) & ~X.looks_french(F.col("body")), "MINEUR", n),
        "R21": F.when(ok & F.col("scan").rlike("(?i)" + "|".join(f"(?:{x})" for x in INJECTIONS)), _injections()).otherwise(none),
        "R24": _if(ok & _stub(), "INFO", F.lit("stub")),
    }


#: The rules that look at one page alone: no links (R5), file names that are not in kebab case (R7), unreadable pages and front matter (R8), required keys and
#: titles that are missing (R9), front matter keys in French (R10), types that do not fit the folder (R11), dates in another format, impossible or yet to come
#: (R12), bodies too short or without a heading, but for redirections and stubs (R14), bodies that do not look French (R17), signs of injection in the prose,
#: but for lines with the title (R21), stubs that wait for content (R24).
PAGE_RULES = ("R5", "R7", "R8", "R9", "R10", "R11", "R12", "R14", "R17", "R21", "R24")


def page_findings(pages: DataFrame, rules: tuple[str, ...] = PAGE_RULES, today: Column | None = None) -> DataFrame:
    """The findings of rules that look at one page alone, in one scan of the pages."""
    told = _page_rules(F.current_date() if today is None else today)
    title = X.strip(F.coalesce(_fm("title"), F.lit("")))
    # What several tests read is worked out once, beside the page.
    pages = pages.withColumns({"scan": X.blank_lines_with(F.coalesce("prose", "body"), title), "_floor": _floor(), "_n": F.length(X.strip(F.col("body")))})
    named = lambda r: F.transform(told[r], lambda x: F.struct(x.severity.alias("severity"), F.lit(r).alias("rule"), x.location.alias("location"), x.observed.alias("observed")))
    each = F.flatten(F.array(*map(named, rules)))
    return pages.select(F.explode(each).alias("x")).select("x.*")


def r1(pages: DataFrame, index: DataFrame) -> DataFrame:
    """Index entries without a page."""
    return _find(index.join(pages.select(F.col("stem").alias("target")).distinct(), "target", "left_anti"), "CRITIQUE", "R1", F.col("target"), F.concat(F.lit("index.md (## "), "section", F.lit(")")))


def r2(pages: DataFrame, index: DataFrame) -> DataFrame:
    """Pages that the index lacks, but for those marked as stubs in any way."""
    left = _first_of_stem(pages).join(index.select(F.col("target").alias("stem")).distinct(), "stem", "left_anti")
    return _find(left.filter(F.coalesce(_fm("stub"), F.lit("")) == ""), "MAJEUR", "R2", F.col("stem"))


def r3(pages: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Links to pages that are not there. ``links``: those of ``told_links``, where they are at hand."""
    return _find((links or told_links(pages)).filter("n is null"), "MAJEUR", "R3", F.col("target"))


def r4(pages: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Links to stems of several folders."""
    return _find((links or told_links(pages)).filter("n > 1"), "MINEUR", "R4", F.col("target"))


def r6(pages: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Pages that no page links to, but for stubs."""
    cited = (links or told_links(pages)).filter("n is not null").select(F.col("target").alias("stem")).distinct()
    return _find(_first_of_stem(pages).filter("not any_stub").join(cited, "stem", "left_anti"), "INFO", "R6", F.col("stem"))


def r13(pages: DataFrame, state: DataFrame) -> DataFrame:
    """Origins whose file name the ledger does not know."""
    base = lambda c: F.substring_index(c, "/", -1)
    p = _ok(pages).filter(F.coalesce(_fm("original_file"), F.lit("")) != "").select("sub", "name", _fm("original_file").alias("origin"), base(_fm("original_file")).alias("b"))
    return _find(p.join(state.select(base(F.col("path")).alias("b")).distinct(), "b", "left_anti"), "MINEUR", "R13", F.col("origin"))


def r15(pages: DataFrame, near: DataFrame, classes: DataFrame) -> DataFrame:
    """Each pair of pages with equal or nearly equal bodies, once. ``near`` (a, b, ratio) has the pairs of representatives, ``classes`` (key, class) the pages of each;
    keys are sub/name. The place is the page of the lower step of 500 characters, then the first by folder and name."""
    place = F.struct(F.floor(F.length("body") / 500).alias("step"), F.array_position(F.array(*map(F.lit, FOLDERS)), F.col("sub")).alias("o"), F.col("name").alias("n"))
    member = lambda n: classes.select(F.col("class").alias(f"c{n}"), F.col("key").alias(n))
    equal = member("a").withColumnRenamed("ca", "c").join(member("b").withColumnRenamed("cb", "c"), "c").filter("a < b").select("a", "b", F.lit(1.0).alias("ratio"))
    alike = near.select(F.col("a").alias("ca"), F.col("b").alias("cb"), "ratio").join(member("a"), "ca").join(member("b"), "cb").select("a", "b", "ratio")
    at = lambda n: pages.select(F.concat_ws("/", "sub", "name").alias(n), F.struct(place.alias("p"), _at().alias("at"), F.concat_ws("/", "sub", "name").alias("rel")).alias(f"at_{n}"))
    j = equal.unionByName(alike).join(at("a"), "a").join(at("b"), "b")
    j = j.select(F.least("at_a", "at_b").alias("x"), F.greatest("at_a", "at_b").alias("y"), "ratio")
    return _find(j, "MINEUR", "R15", F.concat_ws(":", "y.rel", F.round(F.col("ratio") * 100).cast("int").cast("string")), F.col("x.at"))


def r16(pages: DataFrame, index: DataFrame) -> DataFrame:
    """Folders whose pages and index entries differ in number."""
    a = pages.groupBy("sub").agg(F.count("*").alias("n_pages"))
    b = index.groupBy(F.col("section").alias("sub")).agg(F.count("*").alias("n_index"))
    j = a.join(b, "sub", "full_outer").filter(F.col("sub").isin(*FOLDERS)).fillna(0)
    return _find(j.filter("n_pages <> n_index"), "INFO", "R16", F.concat_ws("/", F.col("n_pages").cast("string"), F.col("n_index").cast("string")), F.concat(F.lit("index.md (## "), "sub", F.lit(")")))


def r18(pages: DataFrame, produced: DataFrame, *, least_share: float = 0.2) -> DataFrame:
    """Pages that no ledger line produced; silent while the ledger covers too little."""
    enough = produced.agg(F.count("*").alias("made")).crossJoin(pages.agg(F.count("*").alias("there"))).filter((F.col("made") > 0) & (F.col("made") >= least_share * F.greatest(F.col("there"), F.lit(1))))  # one row each
    left = pages.select("sub", "name", _at().alias("page")).join(produced, "page", "left_anti")
    return _find(left.crossJoin(enough.select(F.lit(1).alias("_one"))), "MAJEUR", "R18", F.lit("not produced"))


def r19(residual: DataFrame) -> DataFrame:
    """Left-over staging folders, of a listing (name)."""
    g = residual.filter(~F.startswith("name", F.lit("."))).agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set("name")), 1, 3), ", ").alias("first")).filter("n > 0")
    return _find(g, "MINEUR", "R19", F.concat(F.col("n").cast("string"), F.lit(": "), "first"), F.lit(".staging/"))


def r20(milestones: DataFrame, now: Column, *, seconds: int = 900) -> DataFrame:
    """The heartbeat (name, value: epoch seconds) is missing or old."""
    g = milestones.filter("name = 'heartbeat'").agg(F.max("value").alias("v"))
    return _find(g.filter(F.col("v").isNull() | (now - F.col("v") > seconds)), "CRITIQUE", "R20", F.coalesce(F.floor((now - F.col("v")) / 60).cast("string"), F.lit("missing")), F.lit("heartbeat"))


def r22(pages: DataFrame, *, least: int = 3) -> DataFrame:
    """Terms in bold on several pages that have no page."""
    terms = pages.filter("body is not null").select("sub", "name", F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("prose", "body"), F.lit(r"\*\*([A-Z](?U:[\w .+-]){3,40})\*\*"), F.lit(1)))).alias("t"))
    n = terms.groupBy(X.strip(F.col("t")).alias("term")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    stems = pages.select(F.col("stem").alias("term")).distinct()
    left = n.join(stems, "term", "left_anti").withColumn("slug", X.slug_ascii(F.col("term"))).join(stems.withColumnRenamed("term", "slug"), "slug", "left_anti")
    return _find(left, "MINEUR", "R22", F.concat_ws(":", "term", F.col("n").cast("string")), F.lit("wiki/"))


def r23(pages: DataFrame, links: DataFrame | None = None, *, least: int = 4) -> DataFrame:
    """Of the pages that link to one page, the first two do not mention each other. Only the two smallest are kept by target, so a hot target costs no more."""
    key = F.struct("sub", "name")
    edges = (links or told_links(pages)).filter("n is not null").select("sub", "name", "target").distinct()
    low = edges.groupBy("target").agg(F.min(key).alias("a"), F.count("*").alias("n")).filter(F.col("n") >= least)
    second = edges.join(low.select("target", "a"), "target").filter(F.struct("sub", "name") > F.col("a")).groupBy("target").agg(F.min(key).alias("b"))
    body = pages.select(key.alias("k"), "stem", "body")
    j = low.join(second, "target").join(body.select(F.col("k").alias("a"), F.col("stem").alias("stem_a"), F.col("body").alias("body_a")), "a").join(body.select(F.col("k").alias("b"), F.col("stem").alias("stem_b"), F.col("body").alias("body_b")), "b")
    apart = j.filter(~F.contains(F.coalesce("body_a", F.lit("")), F.col("stem_b")) & ~F.contains(F.coalesce("body_b", F.lit("")), F.col("stem_a")))
    return _find(apart, "INFO", "R23", F.concat_ws("|", "target", "b.sub", "b.name"), _at("a."))


def all_findings(parts: list[DataFrame]) -> DataFrame:
    """The bag of the findings of all rules."""
    return reduce(DataFrame.unionByName, parts)


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity").agg(F.count("*").alias("n"))


def report_order(findings: DataFrame) -> DataFrame:
    """Findings with their place in the report: by severity, then rule and location as text."""
    s = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    placed = in_order(findings.withColumn("section", s), ["section", "rule", "location", "observed"], "_all")
    first = placed.groupBy("section").agg((F.min("_all") - 1).alias("_before"))  # a row a severity
    return placed.join(first, "section").withColumn("place", F.col("_all") - F.col("_before")).drop("_all", "_before")


def failed(findings: DataFrame) -> DataFrame:
    """One row: is there any critical finding?"""
    return findings.agg(F.coalesce(F.bool_or(F.col("severity") == "CRITIQUE"), F.lit(False)).alias("failed"))
