"""Queries over pages and texts: functions, chunking, similarity, rendering, repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..operators import chunking as C
from ..operators import lint as L
from ..operators import reassemble as A
from ..operators import registry as G
from ..operators import render as V
from ..operators import repair as R
from ..operators import similarity as S
from ..sources import read_table
from .merge import _C, _R
from .registry import Registry

REGISTRY = Registry()
_P = "WITH p AS (SELECT * FROM page WHERE deleted_at IS NULL) "
_SLUG = r"trim(left(trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', '-', 'g'), '-'), 80), '-')"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return L.live_pages(read_table(spark, d, "page"))


def _lf(text: Column) -> Column:
    """A text with LF at its line ends, as a file opened as text has."""
    return F.regexp_replace(text, "\r\n?", "\n")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents")


@REGISTRY.add("slugify_titles", f"SELECT DISTINCT title, {_SLUG.format('title')} AS slug FROM documents WHERE title IS NOT NULL")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("title is not null").select("title").distinct().select("title", X.slugify(F.col("title")).alias("slug"))


@REGISTRY.add("canon_names", rf"SELECT DISTINCT name, regexp_replace(trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g'), '-'), '^(?:(?:le|la|les|l|un|une|des|du|de|the|a|an)(?:-|$))+', '') AS canon FROM entity_page")
def canon(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "entity_page").select("name").distinct().select("name", X.canon(F.col("name")).alias("canon"))


@REGISTRY.add("safe_names", r"""SELECT DISTINCT name, coalesce(nullif(trim(regexp_replace(trim(trim(regexp_replace(name, '[/\\:*?"<>|]', '-', 'g')), '.'), '\s+', ' ', 'g')), ''), 'sans-nom') AS safe FROM entity_page""")
def safe(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "entity_page").select("name").distinct().select("name", X.safe_name(F.col("name")).alias("safe"))


@REGISTRY.add("stub_kinds", r"""SELECT DISTINCT name, CASE WHEN regexp_matches(name, '[0-9]|\.') THEN 'entities' WHEN len(list_filter(string_split_regex(name, '\s+'), lambda w: w <> '')) <= 3 AND regexp_matches(name, '(^|\s)\p{Lu}') THEN 'entities'
 WHEN regexp_matches(name, '\p{Lu}') AND NOT regexp_matches(name, '\p{Ll}') THEN 'entities' ELSE 'concepts' END AS kind FROM entity_page""")
def kinds(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "entity_page").select("name").distinct().select("name", X.stub_kind(F.col("name")).alias("kind"))


@REGISTRY.add("front_matter_parse", _P + r""", l AS (SELECT sub, name, fm AS fm0, text, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM p),
 e AS (SELECT *, list_position(list_transform(ls[2:], lambda x: trim(x) = '---' OR ends_with(trim(x), ' ---')), true) AS fin FROM l),
 h AS (SELECT *, list_filter(list_transform(ls[2:fin + 1], lambda x: regexp_replace(x, '(^|\s+)---\s*$', '')), lambda x: trim(x) <> '' AND NOT starts_with(trim(x), '#')) AS used FROM e),
 r AS (SELECT *, CASE WHEN text IS NULL THEN 'unreadable' WHEN NOT starts_with(text, '---') THEN 'absent' WHEN fin IS NULL OR fin = 0 THEN 'open' WHEN len(list_filter(used, lambda x: NOT regexp_matches(x, '^[ \t]') AND NOT starts_with(trim(x), '-') AND NOT contains(x, ':') AND NOT contains(x, '='))) > 0 THEN 'line' END AS err,
  list_filter(used, lambda x: NOT regexp_matches(x, '^[ \t]') AND NOT starts_with(trim(x), '-')) AS own FROM h),
 k AS (SELECT *, list_transform(own, lambda x: trim(regexp_extract(x, CASE WHEN contains(x, ':') THEN '^([^:]*):' ELSE '^([^=]*)=' END, 1))) AS ks, list_transform(own, lambda x: regexp_replace(trim(regexp_extract(x, CASE WHEN contains(x, ':') THEN '^[^:]*:(.*)$' ELSE '^[^=]*=(.*)$' END, 1)), '^["'']+|["'']+$', '', 'g')) AS vs FROM r)
SELECT sub, name, CASE WHEN err IS NULL THEN coalesce(vs[list_position(ks, 'title')], '') ELSE '' END AS title, CASE WHEN err IS NULL THEN coalesce(vs[list_position(ks, 'type')], '') ELSE '' END AS type, CAST(CASE WHEN err IS NULL THEN len(list_distinct(ks)) ELSE 0 END AS INTEGER) AS keys, err FROM k""")
def front_matter(spark: SparkSession, d: str) -> DataFrame:
    """Every page, with ``err`` where its front matter cannot be read; then it has no title, type or keys. The SQL reads the texts too, line by line."""
    p = _pages(spark, d).withColumn("r", X.front_matter(_lf(F.col("text"))))
    get = lambda k: F.coalesce(F.try_element_at("r.fm", F.lit(k)), F.lit(""))
    err = F.when(F.col("text").isNull(), F.lit("unreadable")).otherwise(F.col("r.err"))
    return p.select("sub", "name", get("title").alias("title"), get("type").alias("type"), F.coalesce(F.size(F.map_keys("r.fm")), F.lit(0)).alias("keys"), err.alias("err"))


@REGISTRY.add("front_matter_get", _P + r"SELECT sub, name, trim(regexp_extract(regexp_extract(text, '(?s)\A---\s*\n(.*?)\n---\s*\n', 1), '(?m)^title:[ \t]*(.*)$', 1)) AS title FROM (SELECT sub, name, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM p) WHERE text IS NOT NULL")
def front_matter_get(spark: SparkSession, d: str) -> DataFrame:
    """Every page with a text, CR and CRLF as line ends."""
    p = _pages(spark, d).filter("text is not null")
    return p.select("sub", "name", X.fm_get(X.fm_block(_lf(F.col("text"))), "title").alias("title"))


_FENCE = r"(?sm)^[ \t]*(?:```|~~~).*?^[ \t]*(?:```|~~~)[ \t]*$"


@REGISTRY.add("strip_code_prose", rf"""SELECT doc_id, CAST(length(regexp_replace(regexp_replace(regexp_replace(text, '{_FENCE}', '', 'g'), '(?m)^(?: {{4}}|\t).*$', '', 'g'), '`[^`\n]*`', '', 'g'))
 + coalesce(list_sum(list_transform(regexp_extract_all(text, '{_FENCE}'), lambda x: length(x) - length(replace(x, chr(10), '')))), 0) AS INTEGER) AS prose_chars FROM documents WHERE text IS NOT NULL""")
def prose(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("text is not null").select("doc_id", F.length(X.strip_code(F.col("text"))).alias("prose_chars"))


@REGISTRY.add("page_links", _P + r"SELECT sub, name, count(*) AS links, count(DISTINCT t) AS targets FROM (SELECT sub, name, trim(unnest(regexp_extract_all(coalesce(prose, body), '\[\[([^\]\[|\n`]{1,120})(?:\|[^\]\n]*)?\]\]', 1))) AS t FROM p WHERE body IS NOT NULL) GROUP BY sub, name")
def links(spark: SparkSession, d: str) -> DataFrame:
    return L.page_links(_pages(spark, d)).groupBy("sub", "name").agg(F.count("*").alias("links"), F.count_distinct("target").alias("targets"))


@REGISTRY.add("looks_french", "SELECT doc_id, len(list_filter(['le','la','les','des','une','est','qui','dans','pour','avec','sur','par'], lambda w: contains(lower(text), ' ' || w || ' '))) >= 3 AS french FROM documents WHERE text IS NOT NULL")
def french(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("text is not null").select("doc_id", X.looks_french(F.col("text")).alias("french"))


@REGISTRY.add("redact_secrets", r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(bot)?[0-9]{8,10}:AA[A-Za-z0-9_-]{30,}', '<REDACTED_TG_TOKEN>', 'g'), '(Bearer|Authorization:)\s*[A-Za-z0-9._~+/=-]{16,}', '\1 <REDACTED>', 'gi'),
 '(ya29\.|AIza|AQ\.|sk-|ghp_|gho_|xox[baprs]-)[A-Za-z0-9._~+/=-]{10,}', '<REDACTED_KEY>', 'g'), '(password|passwd|secret|token|api[_-]?key)(\s*[:=]\s*)[^\s,;]+', '\1\2<REDACTED>', 'gi')) AS digest FROM documents WHERE text IS NOT NULL""")
def redact(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("text is not null").select("doc_id", F.md5(X.redact(F.col("text"))).alias("digest"))


@REGISTRY.add("token_estimate", "SELECT doc_id, CAST(floor(strlen(text) / 2.44) AS BIGINT) + 1 AS tokens FROM documents WHERE text IS NOT NULL")
def tokens(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("text is not null").select("doc_id", N.estimated_tokens(F.col("text")).alias("tokens"))


def _cut(lo: str, hi: str) -> str:
    """SQL of the best place to cut ``text`` of ``n`` characters in the upper half of [lo, hi)."""
    at = f"({lo} + greatest(1, ({hi} - {lo}) // 2))"
    w = f"substr(text, {at} + 1, {hi} - {at})"
    found = [rf"WHEN regexp_matches({w}, '(?s)\A((?:.*\n)?)#{{1,6}} ') THEN {at} + length(regexp_extract({w}, '(?s)\A((?:.*\n)?)#{{1,6}} ', 1))"]
    found += [rf"WHEN regexp_matches({w}, '{x}') THEN {at} + length(regexp_extract({w}, '(?s)\A(.*{x})', 1))" for x in (r"\n\n", r"\n", " ")]
    return f"CASE WHEN {hi} >= n THEN n {' '.join(found)} ELSE {hi} END"


@REGISTRY.add("chunk_spans", f"""WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE text <> ''),
 r AS (SELECT doc_id, 0 AS idx, CAST(0 AS BIGINT) AS a, CAST({_cut("0", "4000")} AS BIGINT) AS z FROM d
  UNION ALL SELECT doc_id, idx + 1, s, CASE WHEN e <= s THEN s + 4000 ELSE e END FROM (SELECT *, CAST({_cut("s", "(s + 4000)")} AS BIGINT) AS e FROM (SELECT doc_id, idx, text, n, CASE WHEN back > a THEN back ELSE z END AS s
   FROM (SELECT r.*, text, n, CAST({_cut("a", "greatest(a + 1, z - 320)")} AS BIGINT) AS back FROM r JOIN d USING (doc_id) WHERE z < n))))
SELECT doc_id, CAST(idx AS INTEGER) AS idx, CAST(a AS INTEGER) AS start, CAST(z AS INTEGER) AS "end" FROM r""")
def chunk_spans(spark: SparkSession, d: str) -> DataFrame:
    return C.document_spans(_docs(spark, d), "doc_id", "text", F.lit(4_000), F.lit(320))


@REGISTRY.add("first_prose_lines", _P + r"""SELECT sub, name, left(list_filter(list_transform(string_split(body, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND NOT regexp_matches(x, '^(?:#|>|-|<!--|\||\*)'))[1], 160) AS line FROM p WHERE body IS NOT NULL""")
def first_lines(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).filter("body is not null").select("sub", "name", X.first_prose_line(F.col("body")).alias("line"))


@REGISTRY.add("lint_r15_near_duplicates")
def near(spark: SparkSession, d: str) -> DataFrame:
    return S.near_duplicates(_pages(spark, d).withColumn("rel", F.concat_ws("/", "sub", "name")), "rel", "body", L.page_order())


@REGISTRY.add("lint_r15_text_classes", _P + "SELECT rel AS key, min(rel) OVER (PARTITION BY body) AS class FROM (SELECT sub || '/' || name AS rel, body FROM p WHERE length(body) >= 200)")
def classes(spark: SparkSession, d: str) -> DataFrame:
    return S.text_classes(_pages(spark, d).withColumn("rel", F.concat_ws("/", "sub", "name")), "rel", "body")


@REGISTRY.add("category_index_pages", _P + """SELECT sub, CAST(CASE WHEN total <= 600 THEN 1 ELSE ceil(rn / 250) END AS BIGINT) AS page_no, min(name) AS first, max(name) AS last, count(*) AS n
 FROM (SELECT sub, name, row_number() OVER (PARTITION BY sub ORDER BY name) AS rn, count(*) OVER (PARTITION BY sub) AS total FROM p) GROUP BY 1, 2""")
def index_pages(spark: SparkSession, d: str) -> DataFrame:
    return V.index_pages(_pages(spark, d))


@REGISTRY.add("index_text", _P + """SELECT sub, page_no, CAST(count(*) AS INTEGER) AS n, string_agg('- [[' || stem || ']]', chr(10) ORDER BY name) AS text
 FROM (SELECT sub, name, stem, CAST(CASE WHEN count(*) OVER (PARTITION BY sub) <= 600 THEN 1 ELSE ceil(row_number() OVER (PARTITION BY sub ORDER BY name) / 250) END AS BIGINT) AS page_no FROM p) GROUP BY sub, page_no""")
def index_text(spark: SparkSession, d: str) -> DataFrame:
    return V.index_text(_pages(spark, d))


@REGISTRY.add("vault_fingerprint", _P + """, h AS (SELECT sha256(sub || ' ' || name || ' ' || sha256(coalesce(text, ''))) AS h FROM p)
SELECT sha256(concat_ws(' ', """ + ", ".join(f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4)) + """, CAST(count(*) AS VARCHAR))) AS fingerprint FROM h""")
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return V.fingerprint(V.page_lines(_pages(spark, d)))


@REGISTRY.add("stage_problems", r"""WITH p AS (SELECT sub, name, coalesce(text, '') AS t FROM page WHERE deleted_at IS NULL),
 x AS (SELECT *, regexp_extract(t, '(?s)\A---\n(.*?)(?:\n---[ \t]*(?:\n|\z)|\z)', 1) AS fm, regexp_replace(regexp_extract(t, '(?s)\A---\n.*?\n---[ \t]*\n(.*)\z', 1), '\n+\z', '') AS body FROM p),
 y AS (SELECT *, regexp_extract(fm, '(?m)^type:\s*"?([A-Za-z_]+)"?', 1) AS kind, strlen(body) < 200 AS short FROM x)
SELECT sub, name, problems FROM (SELECT sub, name, CASE WHEN regexp_matches(name, '[/:*?"<>|]') OR name = '.md' THEN 'name' WHEN NOT starts_with(t, '---' || chr(10)) THEN 'front matter' ELSE concat_ws(',',
 CASE WHEN sub = 'sources' AND NOT regexp_matches(fm, '(?m)^title:') THEN 'key title' END, CASE WHEN sub = 'sources' AND NOT regexp_matches(fm, '(?m)^type:') THEN 'key type' END, CASE WHEN NOT regexp_matches(fm, '(?m)^tags:') THEN 'key tags' END,
 CASE WHEN sub = 'sources' AND NOT regexp_matches(fm, '(?m)^last_updated:') THEN 'key last_updated' END,
 CASE WHEN NOT CASE sub WHEN 'sources' THEN kind = 'source' WHEN 'entities' THEN kind IN ('', 'entity') ELSE kind IN ('', 'concept') END THEN 'type' END, CASE WHEN short THEN 'short' END, CASE WHEN NOT short AND NOT regexp_matches(body, '(?m)^#') THEN 'heading' END) END AS problems FROM y) WHERE problems <> ''""")
def problems(spark: SparkSession, d: str) -> DataFrame:
    return V.stage_problems(_pages(spark, d)).filter("problems <> ''")


@REGISTRY.add("promotion_delta", "WITH a AS (SELECT 'wiki/' || sub || '/' || name AS rel, body AS c FROM page WHERE deleted_at IS NULL AND created_at < TIMESTAMPTZ '2025-06-30 00:00:00+00'), b AS (SELECT 'wiki/' || sub || '/' || name AS rel, coalesce(prose, body) AS c FROM page WHERE deleted_at IS NULL) SELECT rel, CASE WHEN a.c IS NULL THEN 'added' WHEN b.c IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b USING (rel) WHERE a.c IS DISTINCT FROM b.c")
def delta(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).withColumn("rel", F.concat_ws("/", F.lit("wiki"), "sub", "name"))
    old = p.filter("created_at < timestamp '2025-06-30 00:00:00Z'").select("rel", F.col("body").alias("content"))
    return V.changed(p.select("rel", F.coalesce("prose", "body").alias("content")), old)


@REGISTRY.add("source_pages")
def source_pages(spark: SparkSession, d: str) -> DataFrame:
    """The page of each complete document, rendered from its reassembled parts."""
    c = A.complete_chunks(A.chunks(read_table(spark, d, "envelope")))
    head = c.groupBy("sha").agg(F.min_by(F.struct("path", F.col("note.title").alias("title"), F.col("note.doc_date").alias("doc_date"), "extracted_at"), "idx").alias("h"))
    sections = A.merged_sections(c).groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("place", "heading", "markdown"))).alias("sections"))
    tags = A.top_tags(c).groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("place", "tag"))).alias("tags"))
    warnings = A.merged_warnings(c).groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("warnings"))
    m = G.mentions(read_table(spark, d, "envelope"))
    told = V.told_entities(c, G.upsert(m), G.promoted(m))
    j = head.join(A.summaries(c), "sha").join(sections, "sha", "left").join(tags, "sha", "left").join(warnings, "sha", "left").join(told, "sha", "left")
    day = D.note_date(F.col("h.doc_date"), F.col("h.extracted_at"), F.to_date(F.lit("2026-01-01")))
    names = F.coalesce("names", F.create_map().cast("map<string,string>"))
    page = V.source_page(F.coalesce("h.title", F.lit("")), F.transform("tags", lambda t: t.tag), day, F.col("summary"), F.transform("sections", lambda s: F.struct(s.heading.alias("heading"), s.markdown.alias("markdown"))), F.transform("warnings", lambda w: w.text), F.col("entities"), F.col("sha"), F.col("h.path"), names, F.coalesce("promoted", F.array().cast("array<string>")))
    return j.select("sha", page.alias("content"))


@REGISTRY.add("entity_blocks", _C + _R + r""", mt AS (SELECT slug, string_agg('- [[' || doc || ']]' || CASE WHEN ev <> '' THEN ' - ' || ev ELSE '' END, chr(10) ORDER BY doc, ev) AS t FROM (SELECT DISTINCT slug, doc, regexp_replace(coalesce(evidence, ''), '^\s+|\s+$', '', 'g') AS ev FROM m WHERE slug IN (SELECT slug FROM pr WHERE promoted)) GROUP BY slug),
 so AS (SELECT slug, string_agg('- `' || regexp_replace(path, '^.*?/(raw/)', '\1') || '`', chr(10) ORDER BY path) AS t FROM (SELECT DISTINCT slug, path FROM m WHERE path IS NOT NULL) GROUP BY slug),
 nm AS (SELECT slug, arg_min(name, (sha, idx, pos)) AS name FROM m WHERE coalesce(slug, '') <> '' GROUP BY slug),
 li AS (SELECT from_slug AS slug, string_agg('- ' || rel_type || ' : [[' || name || ']]', chr(10) ORDER BY rel_type, name) AS t FROM (SELECT DISTINCT from_slug, rel_type, name FROM g JOIN nm ON nm.slug = to_slug WHERE rel_type IS NOT NULL) GROUP BY 1),
 df AS (SELECT slug, doc, arg_min(definition, (sha, idx, pos)) AS text, arg_min(rank, (sha, idx, pos)) AS rank FROM m WHERE trim(coalesce(definition, '')) <> '' AND coalesce(slug, '') <> '' GROUP BY slug, doc),
 bd AS (SELECT slug, regexp_replace(arg_min(text, (-rank, doc)), '^\s+|\s+$', '', 'g') AS t FROM df GROUP BY slug)
SELECT mt.slug, '<!-- AUTO:BEGIN -->' || chr(10) || chr(10) || CASE WHEN coalesce(bd.t, '') <> '' THEN '## Definition' || chr(10) || chr(10) || bd.t || chr(10) || chr(10) ELSE '' END || '## Mentions' || chr(10) || chr(10) || mt.t || chr(10) || chr(10)
 || CASE WHEN li.t IS NOT NULL THEN '## Liens' || chr(10) || chr(10) || li.t || chr(10) || chr(10) ELSE '' END || '## Sources' || chr(10) || chr(10) || so.t || chr(10) || chr(10) || '<!-- AUTO:END -->' || chr(10) AS block
FROM mt JOIN so USING (slug) LEFT JOIN li USING (slug) LEFT JOIN bd USING (slug)""")
def entity_blocks(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "envelope")
    m = G.mentions(e)
    chosen = G.promoted(m)
    said = G.entity_mentions(m, chosen).select("slug", "doc", X.strip(F.coalesce("evidence", F.lit(""))).alias("evidence")).distinct()
    told = said.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("doc", "evidence"))).alias("mentions"))
    made = m.join(chosen.filter("promoted").select("slug"), "slug", "left_semi").filter("path is not null").select("slug", "path").distinct().groupBy("slug").agg(F.array_sort(F.collect_list("path")).alias("sources"))
    names = G.upsert(m).select(F.col("slug").alias("to_slug"), "name")
    ends = G.relation_graph(e, chosen).join(names, "to_slug").filter("rel_type is not null").select(F.col("from_slug").alias("slug"), "rel_type", "name").distinct()
    out = ends.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("rel_type", "name"))).alias("links"))
    j = told.join(made, "slug").join(G.best_definitions(G.definitions(m)).select("slug", F.col("text").alias("definition")), "slug", "left").join(out, "slug", "left")
    return V.entity_block(j.withColumn("links", F.coalesce("links", F.array().cast(out.schema["links"].dataType))))


@REGISTRY.add("fix_front_matter_plan", _P + r"""SELECT sub, name, CASE WHEN skip IS NULL THEN concat_ws(',', CASE WHEN coalesce(fm['type'], '') = '' THEN 'type' END, CASE WHEN coalesce(fm['title'], '') = '' THEN 'title' END, CASE WHEN sub = 'sources' AND coalesce(fm['last_updated'], '') = '' THEN 'last_updated' END) END AS added, skip
 FROM (SELECT *, CASE WHEN contains(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13)) THEN 'cr' WHEN err IS NOT NULL OR fm IS NULL THEN 'front matter' WHEN lower(coalesce(fm['stub'], '')) = 'true' THEN 'stub' END AS skip FROM p)""")
def fix_plan(spark: SparkSession, d: str) -> DataFrame:
    return R.front_matter_plan(_pages(spark, d)).select("sub", "name", "added", "skip")


_PLAN = r""", q0 AS (SELECT *, CASE WHEN contains(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13)) THEN 'cr' WHEN err IS NOT NULL OR fm IS NULL THEN 'front matter' WHEN lower(coalesce(fm['stub'], '')) = 'true' THEN 'stub' END AS skip,
  regexp_replace(regexp_extract(body, '(?m)^#\s+(.+)$', 1), '^\s+|\s+$', '', 'g') AS head FROM p),
 q1 AS (SELECT *, CASE WHEN skip IS NULL THEN list_filter([CASE WHEN coalesce(fm['type'], '') = '' THEN 'type' END, CASE WHEN coalesce(fm['title'], '') = '' THEN 'title' END, CASE WHEN sub = 'sources' AND coalesce(fm['last_updated'], '') = '' THEN 'last_updated' END], lambda x: x IS NOT NULL) ELSE [] END AS added,
  skip IS NULL AND coalesce(length(regexp_replace(body, '^\s+|\s+$', '', 'g')) >= 200 AND NOT regexp_matches(body, '(?m)^#'), false) AS put FROM q0) """


@REGISTRY.add("fix_plan_counters", _P + _PLAN + """SELECT what, count(*) AS n FROM (SELECT 'added:' || unnest(added) AS what FROM q1 UNION ALL SELECT 'title from:' || CASE WHEN coalesce(head, '') <> '' THEN 'heading' ELSE 'file name' END FROM q1 WHERE list_contains(added, 'title')
 UNION ALL SELECT 'line ends:' || CASE WHEN contains(coalesce(text, ''), chr(13) || chr(10)) THEN 'crlf' ELSE 'lf' END FROM q1 WHERE len(added) > 0 OR put UNION ALL SELECT 'skip:' || skip FROM q1 WHERE skip IS NOT NULL) GROUP BY what""")
def fix_counters(spark: SparkSession, d: str) -> DataFrame:
    return R.plan_counters(R.front_matter_plan(_pages(spark, d)))


@REGISTRY.add("fix_verify", _P + _PLAN + "SELECT CASE WHEN put THEN 'heading added' ELSE 'same' END AS verdict, count(*) AS n FROM q1 WHERE skip IS NULL AND (len(added) > 0 OR put) GROUP BY 1")
def fix_verify(spark: SparkSession, d: str) -> DataFrame:
    """What the repair did to each body: the new texts are parsed again and compared with the old."""
    p = _pages(spark, d)
    rel = F.concat_ws("/", "sub", "name").alias("rel")
    new = R.fixed_text(p, F.to_date(F.lit("2026-01-01")), F.col("created_at"))
    after = new.select(rel, X.front_matter(F.replace("new_text", F.lit("\r\n"), F.lit("\n"))).body.alias("body"))
    before = p.select(rel, F.replace("body", F.lit("\r\n"), F.lit("\n")).alias("body"))
    return R.verify(before, after).groupBy("verdict").agg(F.count("*").alias("n"))


@REGISTRY.add("stub_targets", _P + r""", l AS (SELECT sub, name, trim(unnest(regexp_extract_all(coalesce(prose, body), '\[\[([^\]\[|\n`]{1,120})(?:\|[^\]\n]*)?\]\]', 1))) AS t FROM p WHERE body IS NOT NULL)
SELECT t AS target, count(DISTINCT (sub, name)) AS pages FROM l WHERE t <> '' AND t NOT IN (SELECT stem FROM p) AND NOT regexp_matches(t, '[/\\:*?"<>|]') GROUP BY t""")
def stubs(spark: SparkSession, d: str) -> DataFrame:
    return R.stub_targets(_pages(spark, d)).select("target", "pages")


_LINKED = r"regexp_extract_all({0}, '\[\[([^\]\[|\n`]{{1,120}})(?:\|[^\]\n]*)?\]\]', 1)"


@REGISTRY.add("stub_pages", _P + rf""", st AS (SELECT DISTINCT t FROM (SELECT regexp_replace(unnest({_LINKED.format("coalesce(prose, body)")}), '^\s+|\s+$', '', 'g') AS t FROM p WHERE body IS NOT NULL) WHERE t <> '' AND t NOT IN (SELECT stem FROM p) AND NOT regexp_matches(t, '[/\\:*?"<>|]')),
 ln AS (SELECT sub, name, unnest(string_split(body, chr(10))) AS line, unnest(range(len(string_split(body, chr(10))))) AS pos FROM p WHERE body IS NOT NULL),
 lk AS (SELECT sub, name, pos, left(regexp_replace(regexp_replace(line, '^\s+|\s+$', '', 'g'), '^[-*>#\s]+', ''), 400) AS line, regexp_replace(unnest({_LINKED.format("line")}), '^\s+|\s+$', '', 'g') AS t FROM ln WHERE contains(line, '[[')),
 fl AS (SELECT t, sub, name, arg_min(line, pos) AS line FROM lk WHERE t IN (SELECT t FROM st) GROUP BY t, sub, name),
 rk AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY sub, name) AS r FROM fl),
 ms AS (SELECT t, string_agg('- [[' || regexp_replace(name, '\.md$', '') || ']] : ' || line, chr(10) ORDER BY sub, name) AS told FROM rk WHERE r <= 20 GROUP BY t),
 k AS (SELECT t, told, CASE WHEN regexp_matches(t, '[0-9]|\.') THEN 'entities' WHEN len(list_filter(string_split_regex(t, '\s+'), lambda w: w <> '')) <= 3 AND regexp_matches(t, '(^|\s)\p{{Lu}}') THEN 'entities' WHEN regexp_matches(t, '\p{{Lu}}') AND NOT regexp_matches(t, '\p{{Ll}}') THEN 'entities' ELSE 'concepts' END AS kind FROM ms)
SELECT 'wiki/' || kind || '/' || coalesce(nullif(trim(regexp_replace(trim(trim(regexp_replace(t, '[/\\:*?"<>|]', '-', 'g')), '.'), '\s+', ' ', 'g')), ''), 'sans-nom') || '.md' AS rel,
 '---' || chr(10) || 'title: "' || replace(replace(t, '\', '\\'), '"', '\"') || '"' || chr(10) || 'type: ' || CASE kind WHEN 'entities' THEN 'entity' ELSE 'concept' END || chr(10) || 'tags: ["a-enrichir"]' || chr(10) || 'last_updated: 2026-01-01' || chr(10) || 'stub: true' || chr(10) || '---' || chr(10) || chr(10) || '# ' || t || chr(10) || chr(10) || told || chr(10) AS content FROM k""")
def stub_pages(spark: SparkSession, d: str) -> DataFrame:
    return R.stub_pages(_pages(spark, d), F.to_date(F.lit("2026-01-01")))
