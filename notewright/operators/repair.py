"""Repairs: front matter, stubs for pages that are only linked, malformed links, and the check of what a repair did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from .lint import page_links

TYPE_OF = {"sources": "source", "entities": "entity", "concepts": "concept"}


def _type_of() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in TYPE_OF.items() for x in kv]), F.col("sub"))


def derived_title(fm: Column, body: Column, stem: Column) -> Column:
    """struct(title, origin): from the front matter, else the first heading, else the file name."""
    own = F.nullif(F.coalesce(F.try_element_at(fm, F.lit("title")), F.lit("")), F.lit(""))
    head = F.nullif(X.strip(F.regexp_extract(body, r"(?m)^#\s+(.+)$", 1)), F.lit(""))
    return F.struct(F.coalesce(own, head, stem).alias("title"), F.when(own.isNotNull(), "front matter").when(head.isNotNull(), "heading").otherwise("file name").alias("origin"))


#: Front matter keys that may tell when a page was last changed, the best first. Fixed values.
DATE_ORDER = ("last_updated", "date_added", "date", "created_at", "ingested")


def derived_date(fm: Column, changed: Column, today: Column) -> Column:
    """struct(day, origin): the first valid date of the front matter that is not yet to come, else the day the file was changed, today at the latest."""
    value = lambda k: F.try_element_at(fm, F.lit(k))
    good = lambda k: (F.coalesce(value(k), F.lit("")) != "") & D.date_problem(X.strip(value(k)), today).isNull()
    found = F.coalesce(*[F.when(good(k), F.struct(F.left(X.strip(value(k)), F.lit(10)).alias("day"), F.lit(k).alias("origin"))) for k in DATE_ORDER])
    last = F.date_format(F.least(F.coalesce(changed.cast("date"), today), today), "yyyy-MM-dd")
    return F.coalesce(found, F.struct(last.alias("day"), F.lit("file").alias("origin")))


def front_matter_plan(pages: DataFrame) -> DataFrame:
    """(sub, name, added, origin, insert_title, skip): keys to add and whether a heading is to be put in; values that are there are never changed."""
    fm = lambda k: F.coalesce(F.try_element_at("fm", F.lit(k)), F.lit(""))
    lone = F.contains(F.replace(F.coalesce("text", F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"))
    skip = F.when(lone, "cr").when(F.col("err").isNotNull() | F.col("fm").isNull(), "front matter").when(F.lower(fm("stub")) == "true", "stub")
    t = derived_title(F.col("fm"), F.col("body"), F.col("stem"))
    added = F.array_compact(F.array(F.when(fm("type") == "", F.lit("type")), F.when(fm("title") == "", F.lit("title")), F.when((F.col("sub") == "sources") & (fm("last_updated") == ""), F.lit("last_updated"))))
    put = (F.length(X.strip(F.col("body"))) >= 200) & ~F.col("body").rlike("(?m)^#")
    return pages.select("sub", "name", F.when(skip.isNull(), F.array_join(added, ",")).alias("added"), F.when(skip.isNull(), t.origin).alias("origin"), (skip.isNull() & F.coalesce(put, F.lit(False))).alias("insert_title"), skip.alias("skip"), F.contains(F.coalesce("text", F.lit("")), F.lit("\r\n")).alias("crlf"))


def fixed_text(pages: DataFrame, today: Column, changed: Column) -> DataFrame:
    """(sub, name, new_text): pages with the missing keys at the end of their front matter and, where planned, a heading; line ends as they were. ``changed`` is when
    a page's file was changed."""
    plan = front_matter_plan(pages).filter("skip is null and (added <> '' or insert_title)")
    j = pages.join(plan.select("sub", "name", "added", "insert_title", "crlf"), ["sub", "name"])
    lf = F.replace("text", F.lit("\r\n"), F.lit("\n"))
    has = lambda k: F.array_contains(F.split("added", ","), k)
    title = derived_title(F.col("fm"), F.col("body"), F.col("stem")).title
    lines = F.concat_ws("", F.when(has("type"), F.concat(F.lit("type: "), _type_of(), F.lit("\n"))), F.when(has("title"), F.concat(F.lit("title: "), X.yaml_quote(title), F.lit("\n"))), F.when(has("last_updated"), F.concat(F.lit("last_updated: "), derived_date(F.col("fm"), changed, today).day, F.lit("\n"))))
    close = F.instr(F.substring(lf, F.lit(4), F.length(lf)), "\n---") + 3
    new = F.concat(F.left(lf, close), lines, F.substring(lf, close + 1, F.lit(3)), F.when(F.col("insert_title"), F.concat(F.lit("\n\n# "), title)).otherwise(F.lit("")), F.substring(lf, close + 4, F.length(lf)))
    return j.select("sub", "name", F.when(F.col("crlf"), F.replace(new, F.lit("\n"), F.lit("\r\n"))).otherwise(new).alias("new_text"))


def plan_counters(plan: DataFrame) -> DataFrame:
    """(what, n): keys added, where added titles came from, line ends of the pages that change, and pages skipped, by kind. One scan of the plan."""
    told = lambda cond, head, x: F.when(cond, F.array(F.concat(F.lit(head), x))).otherwise(F.array().cast("array<string>"))
    adds = F.coalesce(F.col("added"), F.lit("")) != ""
    keys = F.when(adds, F.transform(F.split("added", ","), lambda k: F.concat(F.lit("added:"), k))).otherwise(F.array().cast("array<string>"))
    title = told(adds & F.array_contains(F.split("added", ","), "title"), "title from:", F.col("origin"))
    ends = told(adds | F.col("insert_title"), "line ends:", F.when(F.col("crlf"), F.lit("crlf")).otherwise(F.lit("lf")))
    return plan.select(F.explode(F.concat(keys, title, ends, told(F.col("skip").isNotNull(), "skip:", F.col("skip")))).alias("what")).groupBy("what").agg(F.count("*").alias("n"))


def stub_targets(pages: DataFrame) -> DataFrame:
    """(target, kind, pages): pages that are linked but not there, with their folder and how many pages link to them."""
    links = page_links(pages).filter("target <> ''").join(pages.select(F.col("stem").alias("target")).distinct(), "target", "left_anti")
    good = links.filter(~F.col("target").rlike(r'[/\\:*?"<>|]'))
    return good.groupBy("target").agg(F.count_distinct("sub", "name").alias("pages")).select("target", X.stub_kind(F.col("target")).alias("kind"), "pages")


def stub_mentions(pages: DataFrame) -> DataFrame:
    """(target, sub, name, line): the first line of each page that links to a page that is not there."""
    lines = pages.filter("body is not null").select("sub", "name", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    links = lines.filter(F.contains("line", F.lit("[["))).select("sub", "name", "pos", "line", F.explode(X.wikilinks(F.col("line"))).alias("target"))
    left = links.filter("target <> ''").join(pages.select(F.col("stem").alias("target")).distinct(), "target", "left_anti")
    clean = F.left(F.regexp_replace(X.strip(F.col("line")), r"^[-*>#\s]+", ""), F.lit(400))
    return left.groupBy("target", "sub", "name").agg(F.min_by(clean, "pos").alias("line"))


def stub_pages(pages: DataFrame, today: Column) -> DataFrame:
    """(rel, content): a page for each target that is not there, with up to its first twenty mentions by page name. Mentions are ranked by target, not collected whole."""
    from pyspark.sql.window import Window

    first = stub_mentions(pages).withColumn("r", F.row_number().over(Window.partitionBy("target").orderBy("sub", "name"))).filter("r <= 20")
    m = first.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("sub", "name", "line"))).alias("ms"))
    t = stub_targets(pages).join(m, "target")
    text = F.concat(F.lit("---\ntitle: "), X.yaml_quote(F.col("target")), F.lit("\ntype: "), F.when(F.col("kind") == "entities", "entity").otherwise("concept"), F.lit('\ntags: ["a-enrichir"]\nlast_updated: '), F.date_format(today, "yyyy-MM-dd"), F.lit("\nstub: true\n---\n\n# "), F.col("target"), F.lit("\n\n"), F.array_join(F.transform("ms", lambda x: F.concat(F.lit("- [["), F.regexp_replace(x["name"], r"\.md$", ""), F.lit("]] : "), x.line)), "\n"), F.lit("\n"))
    return t.select(F.concat(F.lit("wiki/"), "kind", F.lit("/"), X.safe_name(F.col("target")), F.lit(".md")).alias("rel"), text.alias("content"))


#: Signs of a shell test between double brackets. Fixed value.
SHELL = r"""^\s*(?:[-!$:]|\d+\s|\w+\s+-(?:eq|ne|lt|gt|z|n|r|s|f|d)\b)|["']|&&|\|\||-eq|-ne|\$\{|\$\("""
LINK = r"\[\[([^\]\[|\n]{1,120})(\|[^\]\n]*)?\]\]"


def repaired_links(text: Column, there: Column) -> Column:
    """Double brackets that hold shell tests become inline code. Links to pages that are ``there`` (an array of names), paths, and what begins with a letter or a
    digit stay as they are."""

    def one(whole: Column, target: Column) -> Column:
        page = F.array_contains(there, target) | F.array_contains(there, X.strip(target))
        path = F.contains(target, F.lit("/")) & ~F.contains(target, F.lit(" "))
        return F.when(~page & ~path & target.rlike(SHELL) & ~target.rlike("^[A-Za-zÀ-ÿ0-9]"), F.concat(F.lit("`"), target, F.lit("`"))).otherwise(whole)

    found = F.zip_with(F.regexp_extract_all(text, F.lit(LINK), F.lit(0)), F.regexp_extract_all(text, F.lit(LINK), F.lit(1)), one)
    return F.array_join(F.zip_with(F.split(text, LINK, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def link_repairs(pages: DataFrame) -> DataFrame:
    """(sub, name, new_text): the pages whose links a repair changes. Which targets are pages is joined, by name, not looked up in a list of all."""
    p = pages.filter(F.contains("text", F.lit("[["))).select("sub", "name", "text")
    targets = p.select("sub", "name", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(LINK), F.lit(1)), X.strip))).alias("stem"))
    there = targets.join(pages.select("stem").distinct(), "stem", "left_semi").groupBy("sub", "name").agg(F.collect_set("stem").alias("there"))
    none = F.array().cast("array<string>")
    out = p.join(there, ["sub", "name"], "left").select("sub", "name", "text", repaired_links(F.col("text"), F.coalesce("there", none)).alias("new_text"))
    return out.filter("new_text <> text").select("sub", "name", "new_text")


def closed_front_matter(text: Column, mark: str = "[truncated]") -> Column:
    """A page that was cut inside its front matter, and says so, with the front matter closed before the mark; other pages as they are."""
    cut = F.startswith(text, F.lit("---\n")) & ~F.substring(text, F.lit(4), F.length(text)).rlike(r"(?m)^---\s*$") & F.contains(text, F.lit(mark))
    return F.when(cut, F.concat(X.strip(F.substring_index(text, mark, 1)), F.lit(f"\n---\n\n{mark}\n"))).otherwise(text)


def renamed_links(text: Column, old: str, new: str) -> Column:
    """Links to one page as links to another."""
    return F.replace(F.replace(text, F.lit(f"[[{old}]]"), F.lit(f"[[{new}]]")), F.lit(f"[[{old}|"), F.lit(f"[[{new}|"))


def verify(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rel, verdict): is the body of each repaired page (rel, body) the old one, the old one under a new heading, or something else?"""
    j = before.select("rel", F.col("body").alias("a")).join(after.select("rel", F.col("body").alias("b")), "rel")
    rest = X.strip(F.regexp_replace(X.strip(F.col("b")), r"^# [^\n]*\n", ""))
    return j.select("rel", F.when(X.strip(F.col("a")) == X.strip(F.col("b")), "same").when(rest == X.strip(F.col("a")), "heading added").otherwise("other").alias("verdict"))
