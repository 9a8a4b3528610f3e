"""Pages, indexes and journals as text columns, and what a run changes of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

PAGE_ROWS, PAGINATE_OVER = 250, 600
BEGIN, END = "<!-- AUTO:BEGIN -->", "<!-- AUTO:END -->"


def index_pages(pages: DataFrame, *, rows: int = PAGE_ROWS, over: int = PAGINATE_OVER) -> DataFrame:
    """(sub, page_no, first, last, n): the index of each folder in pages of ``rows`` names, sorted by file name; one page up to ``over`` names."""
    return paginated(pages, [], rows, over).groupBy("sub", "page_no").agg(F.min("name").alias("first"), F.max("name").alias("last"), F.count("*").alias("n"))


def paginated(pages: DataFrame, keep: list[str], rows: int, over: int) -> DataFrame:
    """(sub, name, page_no, keep): the page of its folder's index that each name is on. Ranked in two steps: names are counted by their first signs, so that no
    task sorts a whole folder."""
    p = pages.select("sub", "name", *keep, F.left("name", F.lit(4)).alias("head"))
    starts = p.groupBy("sub", "head").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(Window.partitionBy("sub").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy("sub"))).drop("n")
    r = p.withColumn("r", F.row_number().over(Window.partitionBy("sub", "head").orderBy("name"))).join(starts, ["sub", "head"])
    no = F.when(F.col("total") <= over, 1).otherwise(F.ceil((F.col("start") + F.col("r")) / rows)).cast("long")
    return r.select("sub", "name", *keep, no.alias("page_no"))


def index_text(pages: DataFrame, *, rows: int = PAGE_ROWS, over: int = PAGINATE_OVER) -> DataFrame:
    """(sub, page_no, n, text): the links of each page of a folder's index, in the order of names. A row holds ``over`` links at most."""
    link = F.concat(F.lit("- [["), F.col("stem"), F.lit("]]"))
    g = paginated(pages, ["stem"], rows, over).groupBy("sub", "page_no").agg(F.array_sort(F.collect_list(F.struct("name", link.alias("l")))).alias("ls"))
    return g.select("sub", "page_no", F.size("ls").alias("n"), F.array_join(F.transform("ls", lambda x: x.l), "\n").alias("text"))


def index_summary(index: DataFrame) -> DataFrame:
    """(sub, page_no, line): the lines of a folder's index summary: a link to each page of the index with its first and last name."""
    first, last = (F.regexp_replace(c, r"\.md$", "") for c in ("first", "last"))
    return index.select("sub", "page_no", F.format_string("- [[index-%s-%03d]] : %s … %s (%d)", "sub", "page_no", first, last, "n").alias("line"))


def entity_block(entities: DataFrame) -> DataFrame:
    """(slug, block): the generated part of an entity page between its marks. ``entities``: slug, definition, mentions ARRAY<STRUCT<doc, evidence>>, links
    ARRAY<STRUCT<rel_type, name>> and sources ARRAY<STRING>."""
    lines = lambda a, f: F.array_join(F.transform(a, f), "\n")
    part = lambda head, body: F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"## {head}\n\n"), body, F.lit("\n\n"))).otherwise(F.lit(""))
    parts = F.concat(
        part("Definition", X.strip(F.col("definition"))),
        part("Mentions", lines("mentions", lambda m: F.concat(F.lit("- [["), m.doc, F.lit("]]"), F.when(F.coalesce(m.evidence, F.lit("")) != "", F.concat(F.lit(" - "), X.strip(m.evidence))).otherwise(F.lit(""))))),
        part("Liens", lines("links", lambda x: F.concat(F.lit("- "), x.rel_type, F.lit(" : [["), x["name"], F.lit("]]")))),
        part("Sources", lines("sources", lambda x: F.concat(F.lit("- `"), X.source_rel(x), F.lit("`")))),
    )
    return entities.select("slug", F.concat(F.lit(BEGIN + "\n\n"), parts, F.lit(END + "\n")).alias("block"))


def source_page(title: Column, tags: Column, day: Column, summary: Column, sections: Column, warnings: Column, entities: Column, sha: Column, path: Column, names: Column, promoted: Column) -> Column:
    """The text of the page of a source document: front matter, title, summary (unless a section is one), sections, warnings as callouts, the pages of its
    entities, and its source. Entity tokens are resolved by ``names`` (map of slug to name) and ``promoted`` (slugs that have a page)."""
    none = F.array().cast("array<string>")
    resolved = lambda x: X.resolve_tokens(X.strip(F.coalesce(x, F.lit(""))), names, promoted)
    rel = X.source_rel(path)
    kept = F.when(F.size(F.coalesce(tags, none)) > 0, tags).otherwise(F.array(F.lit("imported")))
    head = F.concat(F.lit('---\ntitle: "'), F.replace(title, F.lit('"'), F.lit("'")), F.lit('"\ntype: source\ntags: '), X.yaml_list(kept), F.lit("\nsource_count: 1\nlast_updated: "), day, F.lit("\nlinks: "), X.yaml_list(F.array(rel)), F.lit("\n---\n\n# "), title)
    part = lambda heading, text: F.concat(F.lit("## "), heading, F.lit("\n\n"), text)
    told = F.coalesce(F.exists(sections, lambda s: X.canon(F.coalesce(s.heading, F.lit(""))).isin("resume", "summary")), F.lit(False))
    lines = F.concat(
        F.when(told, none).otherwise(F.array(part(F.lit("Resume"), resolved(summary)))),
        F.transform(F.coalesce(sections, F.array().cast("array<struct<heading:string,markdown:string>>")), lambda s: part(F.coalesce(s.heading, F.lit("")), resolved(s.markdown))),
        F.transform(F.coalesce(warnings, none), lambda w: F.concat(F.lit("> [!warning] "), F.replace(resolved(w), F.lit("\n"), F.lit("\n> ")))),
        F.when(F.size(F.coalesce(entities, none)) > 0, F.array(part(F.lit("Entites & Concepts Mentionnes"), F.array_join(F.transform(entities, lambda e: F.concat(F.lit("- [["), e, F.lit("]]"))), "\n")))).otherwise(none),
        F.array(part(F.lit("Sources"), F.concat(F.lit("- `"), rel, F.lit("` (sha "), F.left(sha, F.lit(8)), F.lit(")")))),
    )
    return F.concat(head, F.lit("\n\n"), F.array_join(lines, "\n\n"), F.lit("\n"))


def told_entities(c: DataFrame, registry: DataFrame, chosen: DataFrame) -> DataFrame:
    """(sha, names, promoted, entities): of each document, the names of the entities that its texts and lists name, the slugs among them that have a page, and the
    names, sorted, of its own entities that have one. Names are joined by slug; a document's map holds its own only. ``registry``: slug, name."""
    texts = F.concat(F.array("note.summary"), F.coalesce("note.sections.markdown", F.array().cast("array<string>")), F.coalesce("note.warnings.text", F.array().cast("array<string>")))
    tokens = c.select("sha", F.explode(texts).alias("t")).filter(F.contains("t", F.lit("{{E:"))).select("sha", F.explode(F.regexp_extract_all("t", F.lit(X.TOKEN), F.lit(1))).alias("k")).select("sha", X.canon(F.col("k")).alias("slug"), F.lit(False).alias("own"))
    own = c.select("sha", F.explode("entities.slug").alias("slug"), F.lit(True).alias("own")).filter("coalesce(slug, '') <> ''")
    each = tokens.unionByName(own).groupBy("sha", "slug").agg(F.max("own").alias("own"))
    known = registry.select("slug", "name").join(chosen.filter("promoted").select("slug", F.lit(True).alias("up")), "slug", "left")
    j = each.join(known, "slug").filter("name is not null")
    up = F.coalesce("up", F.lit(False))
    g = j.groupBy("sha").agg(F.map_from_entries(F.collect_list(F.struct("slug", "name"))).alias("names"), F.collect_list(F.when(up, F.col("slug"))).alias("promoted"), F.array_sort(F.collect_set(F.when(up & F.col("own"), F.col("name")))).alias("entities"))
    return g


def journal_entry(sha: Column, day: Column, title: Column, promoted: Column, held: Column) -> Column:
    return F.format_string("## [%s] ingest | %s\n- sha %s\n- %d / %d\n", day, title, F.left(sha, F.lit(8)), promoted, held)


def new_journal_rows(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows (sha, day, slug) whose short hash the journal (sha8) does not have, in the order of day and slug."""
    return rows.withColumn("sha8", F.left("sha", F.lit(8))).join(log.select("sha8").distinct(), "sha8", "left_anti").orderBy("day", "slug")


def changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """(rel, change): pages (rel, content) that a run adds or changes, and those that it leaves out."""
    a = new.select("rel", F.sha2("content", 256).alias("a"))
    b = old.select("rel", F.sha2("content", 256).alias("b"))
    j = a.join(b, "rel", "full_outer")
    return j.filter(~F.col("a").eqNullSafe(F.col("b"))).select("rel", F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").otherwise("changed").alias("change"))


def overlay(staged: DataFrame, real: DataFrame) -> DataFrame:
    """(rel, content): staged pages in place of the real ones."""
    return staged.select("rel", "content").unionByName(real.select("rel", "content").join(staged.select("rel").distinct(), "rel", "left_anti"))


#: Keys that the front matter of a staged page must have, and the type that fits its folder. Fixed values.
STAGE_KEYS = {"sources": ("title", "type", "tags", "last_updated"), "entities": ("tags",), "concepts": ("tags",)}
STAGE_TYPE = {"sources": "source", "entities": "entity", "concepts": "concept"}


def stage_problems(pages: DataFrame) -> DataFrame:
    """(sub, name, problems): what keeps a staged page from being promoted: its folder, its file name, no front matter; then keys it lacks, a type that does not
    fit, a body under 200 bytes (without the line ends at its end), no heading."""
    text = F.coalesce("text", F.lit(""))
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)(?:(?<=\n)---[ \t]*(?:\n|\z)|\z)", 1)
    body = F.regexp_replace(F.regexp_extract(text, r"(?s)\A---\n.*?(?<=\n)---[ \t]*\n(.*)\z", 1), r"\n+\z", "")
    kind = F.regexp_extract(block, r'(?m)^type:\s*"?([A-Za-z_]+)"?', 1)
    fits = F.coalesce(*[F.when(F.col("sub") == s, (kind == t) | ((kind == "") & F.lit(s != "sources"))) for s, t in STAGE_TYPE.items()])
    tell = lambda c, n: F.when(c, F.lit(n))
    first = F.when(~F.col("sub").isin(*STAGE_KEYS), F.lit("folder")).when(F.col("name").rlike(r'[/:*?"<>|]') | (F.col("name") == ".md"), F.lit("name")).when(~F.startswith(text, F.lit("---\n")), F.lit("front matter"))
    keys = [tell(F.col("sub").isin([s for s, ks in STAGE_KEYS.items() if k in ks]) & ~block.rlike(f"(?m)^{k}:"), f"key {k}") for k in STAGE_KEYS["sources"]]
    short = F.octet_length(body) < 200
    rest = F.array_compact(F.array(*keys, tell(~fits, "type"), tell(short, "short"), tell(~short & ~body.rlike("(?m)^#"), "heading")))
    return pages.select("sub", "name", F.coalesce(first, F.array_join(rest, ",")).alias("problems"))


def stage_passes(problems: DataFrame) -> DataFrame:
    """One row: may the whole stage be promoted, and how many of its pages are produced: those without a problem, or with problems of keys, type or heading only."""
    produced = ~F.col("problems").rlike("folder|^name$|front matter|short")
    return problems.agg(F.coalesce(F.bool_and(F.col("problems") == ""), F.lit(True)).alias("passes"), F.count_if(produced).alias("produced"), F.count("*").alias("pages"))


def thick_enough(pages: DataFrame, chosen: DataFrame, *, least: int = 200) -> tuple[DataFrame, DataFrame]:
    """Rendered entity pages (slug, body, is_new) of at least so many bytes, and the promotions (slug, promoted, …) less those of new pages that are too thin."""
    thin = F.octet_length(F.coalesce("body", F.lit(""))) < least
    lost = pages.filter(thin & F.col("is_new")).select("slug").distinct()
    return pages.filter(~thin), chosen.join(lost.withColumn("_thin", F.lit(True)), "slug", "left").withColumn("promoted", F.col("promoted") & F.col("_thin").isNull()).drop("_thin")


def own_pages(produced: DataFrame) -> DataFrame:
    """(sha, produced): of each document the pages it produced (sha, rel), sorted, each once, never the curated index."""
    return produced.filter(~F.col("rel").rlike(r"(?:^|/)index\.md$")).groupBy("sha").agg(F.array_sort(F.collect_set("rel")).alias("produced"))


def merged_ledger_rows(documents: DataFrame, produced: DataFrame) -> DataFrame:
    """The ledger's rows after a merge: documents (sha256, path, size, mtime, attempts, model) with what they produced, to be appended once their pages are promoted."""
    pages = own_pages(produced).withColumnRenamed("sha", "sha256")
    none = F.array().cast("array<string>")
    return documents.join(pages, "sha256", "left").select(*documents.columns, F.lit("merged").alias("status"), F.lit(None).cast("string").alias("reason"), F.coalesce("produced", none).alias("produced"))


def journal_counts(mentions: DataFrame, chosen: DataFrame, before: DataFrame) -> DataFrame:
    """(doc, promoted, held): of each document, how many of its different entities (doc, slug) got a page in this run, and how many have none. ``before``: slugs that
    had a page already."""
    up = chosen.filter("promoted").select("slug", F.lit(True).alias("up")).join(before.select("slug", F.lit(True).alias("old")).distinct(), "slug", "left")
    j = mentions.select("doc", "slug").distinct().join(up, "slug", "left")
    return j.groupBy("doc").agg(F.count_if(F.col("up") & F.col("old").isNull()).alias("promoted"), F.count_if(F.col("up").isNull()).alias("held"))


def run_summary(results: DataFrame) -> DataFrame:
    """(model, ok, calls): of the results of a run (model, status, calls) by model; the row without a model is the whole run."""
    return results.rollup("model").agg(F.count_if(F.col("status") == "ok").alias("ok"), F.sum("calls").alias("calls"), F.grouping("model").alias("_all")).filter("_all = 1 or model is not null").drop("_all")


def fingerprint(lines: DataFrame) -> DataFrame:
    """One row: a digest of the strings ``line`` that no order changes and no number of rows makes large: the sums of four parts of their SHA-256 digests, and
    their number, digested again."""
    h = F.sha2("line", 256)
    part = lambda i: F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)"))
    return lines.agg(*[part(i).alias(f"p{i}") for i in range(4)], F.count("*").alias("n")).select(F.sha2(F.concat_ws(" ", *[F.coalesce(F.col(f"p{i}").cast("string"), F.lit("0")) for i in range(4)], F.col("n").cast("string")), 256).alias("fingerprint"))


def page_lines(pages: DataFrame) -> DataFrame:
    """What a fingerprint of pages covers: folder, name, and a digest of the text."""
    return pages.select(F.concat_ws(" ", "sub", "name", F.sha2(F.coalesce("text", F.lit("")), 256)).alias("line"))


def file_lines(files: DataFrame) -> DataFrame:
    """What a fingerprint of files (path, length, modificationTime) covers, as a listing tells it, without reading them."""
    return files.select(F.concat_ws(" ", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")).alias("line"))


def diverged(before: DataFrame, after: DataFrame) -> DataFrame:
    """One critical finding where the fingerprints (one row each) before and after an audit differ; an audit changes nothing."""
    both = before.select(F.col("fingerprint").alias("a"), F.lit(1).alias("_j")).join(after.select(F.col("fingerprint").alias("b"), F.lit(1).alias("_j")), "_j").filter("a <> b")
    return both.select(F.lit("CRITIQUE").alias("severity"), F.lit("audit").alias("rule"), F.lit("wiki/").alias("location"), F.concat_ws(" ", F.left("a", F.lit(12)), F.left("b", F.lit(12))).alias("observed"))


def json_report(findings: DataFrame, pages: DataFrame, at: str, path: str) -> None:
    """Writes the report as JSON: a folder ``findings`` of one object a line, in as many parts as there are tasks, and ``summary`` with its time and the number of pages."""
    findings.write.mode("overwrite").json(f"{path}/findings")
    pages.agg(F.lit(at).alias("generated_at"), F.count("*").alias("pages")).write.mode("overwrite").json(f"{path}/summary")


def report_lines(ordered: DataFrame, pages: DataFrame, state: DataFrame) -> DataFrame:
    """(section, place, line): the report as lines of Markdown: totals by severity and the ledger's by status (section 0), then a table a severity, its head at
    place 0. ``ordered``: findings with section and place. Lines are rows, so no severity is held in one."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", F.col("rule"), X.table_cell(F.col("location")), X.table_cell(F.coalesce("observed", F.lit("")))), F.lit(" |"))
    body = ordered.select("section", F.col("place").cast("long").alias("place"), row.alias("line"))
    totals = ordered.groupBy("section", "severity").agg(F.count("*").alias("n"))  # a row a severity
    heads = totals.select("section", F.lit(0).cast("long").alias("place"), F.concat(F.lit("## "), "severity", F.lit("\n\n| rule | location | observed |\n|---|---|---|")).alias("line"))
    zero = F.lit(0).cast("long").alias("section")
    count = pages.agg(F.concat(F.lit("pages: "), F.count("*").cast("string")).alias("line")).select(zero, F.lit(0).cast("long").alias("place"), "line")
    sums = totals.select(zero, F.col("section").cast("long").alias("place"), F.concat("severity", F.lit(": "), F.col("n").cast("string")).alias("line"))
    ledger = state.groupBy("status").agg(F.count("*").alias("n")).select(zero, F.lit(9).cast("long").alias("place"), F.concat(F.lit("ledger "), F.coalesce("status", F.lit("none")), F.lit(": "), F.col("n").cast("string")).alias("line"))
    return reduce(DataFrame.unionByName, [body.withColumn("section", F.col("section").cast("long")), heads.withColumn("section", F.col("section").cast("long")), count, sums, ledger])


def newest(files: DataFrame, group: str, at: str, keep: int) -> DataFrame:
    """(…, keep): the ``keep`` newest of each group stay."""
    return files.withColumn("keep", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(at), F.desc("name"))) <= keep)
