"""Queries over extractions: validation, reassembly, the registry of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SLUG_STOP
from ..operators import extraction as V
from ..operators import reassemble as A
from ..operators import registry as G
from ..sources import read_table
from .registry import Registry

REGISTRY = Registry()
_C = """
WITH c AS (SELECT source.sha256 AS sha, source.chunk.idx AS idx, any_value(source.chunk.total) AS total, any_value(note) AS note, any_value(entities) AS entities, any_value(relations) AS relations,
  any_value(extraction) AS extraction, any_value(source.path) AS path FROM envelope GROUP BY 1, 2),
e AS (SELECT sha, idx, path, note.slug AS doc, i - 1 AS pos, entities[i] AS e FROM (SELECT *, unnest(range(1, len(entities) + 1)) AS i FROM c)),
m AS (SELECT sha, idx, pos, path, doc, e.slug AS slug, e.name AS name, e.kind AS kind, e.subtype AS subtype, e.aliases AS aliases, e.tags AS tags, e.definition AS definition, e.evidence AS evidence, e.salience AS salience,
  CASE e.salience WHEN 'primary' THEN 2 WHEN 'secondary' THEN 1 ELSE 0 END AS rank FROM e),
pr AS (SELECT slug, count(DISTINCT doc) AS docs, coalesce(bool_or(salience = 'primary'), false) AS is_primary, count(DISTINCT doc) >= 2 OR coalesce(bool_or(salience = 'primary'), false) AS promoted FROM m WHERE coalesce(slug, '') <> '' GROUP BY slug)
"""


def _env(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "envelope")


def _once(spark: SparkSession, d: str) -> DataFrame:
    """The extractions, rows delivered twice once, before anything is made of them."""
    return _env(spark, d).withColumn("_idx", F.col("source.chunk.idx")).withColumn("_sha", F.col("source.sha256")).dropDuplicates(["_sha", "_idx"]).drop("_sha", "_idx")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return A.chunks(_env(spark, d))


def _slugged(x: str, n: int = 80) -> str:
    return f"trim(left(trim(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[^a-z0-9]+', '-', 'g'), '-'), {n}), '-')"


def _bare(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '^\s+|\s+$', '', 'g')"


_STOP = ", ".join(f"'{w}'" for w in SLUG_STOP)
_PARTS = f"list_filter(string_split({{0}}, '-'), lambda w: w <> '' AND w NOT IN ({_STOP}))"
_VALID = _C + rf""", v0 AS (SELECT sha, idx, note, entities, relations, extraction, {_bare("note.title")} AS title, {_bare("note.slug")} AS own, regexp_replace(split_part(coalesce(path, ''), '/', -1), '^(.+)\.[^.]*$', '\1') AS stem,
  list_filter(coalesce(note.sections, []), lambda s: {_bare("s.markdown")} <> '') AS sections, list_distinct(list_filter(list_transform(coalesce(note.tags, []), lambda t: {_slugged("t", 40)}), lambda t: regexp_full_match(t, '[a-z0-9-]{{1,40}}'))) AS tags, {_bare("note.doc_date")} AS day FROM c),
 v1 AS (SELECT *, CASE WHEN regexp_full_match(own, '[a-z0-9-]{{1,80}}') THEN own ELSE nullif({_slugged("CASE WHEN own <> '' THEN own ELSE title END")}, '') END AS slug,
  list_filter([{_slugged("title")}, {_slugged("stem")}, {_slugged(r"regexp_replace(stem, '^\d{4}-\d{2}-\d{2}[-_]|[-_][0-9a-f]{8}$', '', 'g')")}], lambda x: length(x) >= 8) AS ident FROM v0),
 e0 AS (SELECT sha, idx, ident, pos, regexp_replace({_bare("e.name")}, '[/\\:*?"<>|]', '-', 'g') AS name, {_bare("e.slug")} AS s FROM (SELECT sha, idx, ident, unnest(entities) AS e, unnest(range(len(entities))) AS pos FROM v1)),
 e1 AS (SELECT *, CASE WHEN regexp_full_match(s, '[a-z0-9-]{{1,80}}') THEN s ELSE nullif({_slugged("CASE WHEN s <> '' THEN s ELSE name END")}, '') END AS slug FROM e0),
 e2 AS (SELECT *, {_PARTS.format("slug")} AS mine, flatten(list_transform(ident, lambda i: {_PARTS.format("i")})) AS theirs FROM e1 WHERE {_bare("name")} <> '' AND slug IS NOT NULL AND NOT regexp_matches(slug, '\d{{4}}-\d{{2}}-\d{{2}}')),
 e3 AS (SELECT *, len(list_filter(mine, lambda w: list_contains(theirs, w))) AS common FROM e2),
 e4 AS (SELECT sha, idx, list(DISTINCT slug) AS slugs FROM e3 WHERE NOT (len(list_filter(ident, lambda i: i = slug OR length(slug) >= 25 AND (starts_with(i, slug) OR starts_with(slug, i)))) > 0 OR len(mine) >= 4 AND common >= 3 AND common / greatest(len(mine), 1) >= 0.5) GROUP BY sha, idx),
 v2 AS (SELECT v1.*, coalesce(e4.slugs, []) AS slugs FROM v1 LEFT JOIN e4 USING (sha, idx)),
 v3 AS (SELECT *, len(list_filter(coalesce(relations, []), lambda r: list_contains(slugs, {_bare("r.from_slug")}) AND list_contains(slugs, {_bare("r.to_slug")}) AND {_bare("r.from_slug")} <> {_bare("r.to_slug")})) AS kept,
  coalesce(list_sum(list_transform(sections, lambda s: length({_bare("s.markdown")}))), 0) AS body, list_distinct(flatten(list_transform(sections, lambda s: regexp_extract_all(s.markdown, '\{{\{{E:([^}}]{{1,120}})\}}\}}', 1)))) AS tokens FROM v2)
SELECT sha AS sha256, idx AS chunk_idx, concat_ws(',', CASE WHEN title = '' THEN 'title' END, CASE WHEN slug IS NULL THEN 'slug' END, CASE WHEN len(sections) = 0 THEN 'sections' END, CASE WHEN body < 200 THEN 'body' END, CASE WHEN len(tags) = 0 THEN 'tags' END) AS errors,
 concat_ws(',', CASE WHEN {_bare("note.summary")} = '' THEN 'summary' END, CASE WHEN len(tags) <> len(coalesce(note.tags, [])) THEN 'tags' END, CASE WHEN day <> '' AND NOT regexp_full_match(day, '\d{{4}}-\d{{2}}-\d{{2}}') THEN 'doc_date' END,
  CASE WHEN len(slugs) <> len(coalesce(entities, [])) THEN 'entities' END, CASE WHEN len(list_filter(tokens, lambda t: NOT list_contains(slugs, t))) > 0 THEN 'tokens' END, CASE WHEN len(list_filter(sections, lambda s: contains(s.markdown, '[['))) > 0 THEN 'wikilink' END,
  CASE WHEN kept <> len(coalesce(relations, [])) THEN 'relations' END, CASE WHEN len(list_filter(coalesce(note.warnings, []), lambda w: coalesce(w.about, '') <> '' AND NOT list_contains(slugs, w.about))) > 0 THEN 'about' END, CASE WHEN extraction.confidence IS NULL THEN 'confidence' END) AS warnings,
 CAST(len(sections) AS INTEGER) AS sections, CAST(len(slugs) AS INTEGER) AS entities, CAST(kept AS INTEGER) AS relations, greatest(0.0, least(1.0, coalesce(extraction.confidence, 0.0)))::DOUBLE AS confidence FROM v3"""


@REGISTRY.add("extraction_validate", _VALID)
def validate(spark: SparkSession, d: str) -> DataFrame:
    """Each extraction with its errors and warnings and what is left of it."""
    v = V.validate(_once(spark, d))
    return v.select("sha256", "chunk_idx", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), F.size("sections").alias("sections"), F.size("entities").alias("entities"), F.size("relations").alias("relations"), "confidence")


@REGISTRY.add("extraction_errors", _C + r"""SELECT sha AS sha256, idx AS chunk_idx, len(list_filter(note.sections, lambda s: trim(coalesce(s.markdown, '')) <> '')) AS sections,
 coalesce(list_sum(list_transform(list_filter(note.sections, lambda s: trim(coalesce(s.markdown, '')) <> ''), lambda s: length(regexp_replace(s.markdown, '^\s+|\s+$', '', 'g')))), 0) < 200 AS too_short FROM c""")
def errors(spark: SparkSession, d: str) -> DataFrame:
    v = V.validate(_once(spark, d))
    return v.select("sha256", "chunk_idx", F.size("sections").cast("long").alias("sections"), F.array_contains("errors", "body").alias("too_short"))


@REGISTRY.add("extraction_relations", _C + """SELECT sha AS sha256, idx AS chunk_idx, CAST(len(list_filter(relations, lambda r: list_contains(list_transform(entities, lambda x: x.slug), trim(r.from_slug)) AND list_contains(list_transform(entities, lambda x: x.slug), trim(r.to_slug)) AND trim(r.from_slug) <> trim(r.to_slug))) AS BIGINT) AS kept,
 CAST(len(relations) AS BIGINT) AS relations FROM c""")
def relations_kept(spark: SparkSession, d: str) -> DataFrame:
    c = _chunks(spark, d)
    kept = V.normal_relations(F.col("relations"), F.transform("entities", lambda x: x.slug))
    return c.select(F.col("sha").alias("sha256"), F.col("idx").alias("chunk_idx"), F.size(kept).cast("long").alias("kept"), F.size("relations").cast("long").alias("relations"))


@REGISTRY.add("extraction_tags", _C + r"""SELECT sha AS sha256, idx AS chunk_idx, list_aggregate(list_filter(t, lambda x, i: list_position(t, x) = i), 'string_agg', ',') AS tags FROM (SELECT sha, idx, list_filter(list_transform(note.tags, lambda x: trim(regexp_replace(lower(strip_accents(x)), '[^a-z0-9]+', '-', 'g'), '-')), lambda x: x <> '') AS t FROM c) WHERE len(t) > 0""")
def tags(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select(F.col("sha").alias("sha256"), F.col("idx").alias("chunk_idx"), F.array_join(V.normal_tags(F.col("note.tags")), ",").alias("tags")).filter("tags <> ''")


@REGISTRY.add("chunk_completeness", _C + "SELECT sha, count(*) AS chunks, arg_min(total, CAST(idx AS VARCHAR)) AS total, count(*) = arg_min(total, CAST(idx AS VARCHAR)) AS complete FROM c GROUP BY sha")
def completeness(spark: SparkSession, d: str) -> DataFrame:
    return A.completeness(_chunks(spark, d))


@REGISTRY.add("reassemble_tags", _C + "SELECT sha, tag, n, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sha ORDER BY n DESC, tag) AS INTEGER) AS place FROM (SELECT sha, tag, count(*) AS n FROM (SELECT sha, unnest(note.tags) AS tag FROM c) GROUP BY sha, tag)) WHERE place <= 8")
def top_tags(spark: SparkSession, d: str) -> DataFrame:
    return A.top_tags(_chunks(spark, d))


_WHOLE = ", w AS (SELECT sha FROM c GROUP BY sha HAVING count(*) = arg_min(total, CAST(idx AS VARCHAR)))"


@REGISTRY.add("reassemble_summaries", _C + _WHOLE + r""", s AS (SELECT sha, count(*) AS n, list_filter(list(regexp_replace(coalesce(note.summary, ''), '^\s+|\s+$', '', 'g') ORDER BY idx), lambda x: x <> '') AS t FROM c WHERE sha IN (SELECT sha FROM w) GROUP BY sha),
 k AS (SELECT *, list_transform(t, lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g')))) AS keys FROM s)
SELECT sha, CASE WHEN n <= 3 THEN array_to_string(list_filter(t, lambda x, i: list_position(keys, keys[i]) = i), ' ') ELSE coalesce(t[1], '') || ' (document en ' || n || ' parties)' END AS summary FROM k""")
def summaries(spark: SparkSession, d: str) -> DataFrame:
    return A.summaries(A.complete_chunks(_chunks(spark, d)))


_P = r""", s AS (SELECT sha, idx, i - 1 AS sec, note.sections[i].heading AS heading, note.sections[i].markdown AS md FROM (SELECT *, unnest(range(1, len(note.sections) + 1)) AS i FROM c)),
p0 AS (SELECT sha, idx, sec, heading, string_split_regex(md, '\n\s*\n') AS ps FROM s WHERE md IS NOT NULL),
p1 AS (SELECT sha, idx, sec, heading, CAST(i - 1 AS INTEGER) AS pos, ps[i] AS paragraph, lower(trim(regexp_replace(ps[i], '[\s\x{A0}\x{202F}]+', ' ', 'g'))) AS key FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM p0)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha, key ORDER BY idx, sec, pos) AS rn FROM p1 WHERE key <> '') WHERE rn = 1)
"""


@REGISTRY.add("reassemble_paragraphs", _C + _P + "SELECT sha, count(*) AS paragraphs, CAST(sum(length(paragraph)) AS BIGINT) AS chars FROM p GROUP BY sha")
def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return A.paragraphs(_chunks(spark, d)).groupBy("sha").agg(F.count("*").alias("paragraphs"), F.sum(F.length("paragraph")).alias("chars"))


_CANON = r"regexp_replace(trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', '-', 'g'), '-'), '^(?:(?:le|la|les|l|un|une|des|du|de|the|a|an)(?:-|$))+', '')"


@REGISTRY.add("reassemble_sections", _C + _P + _WHOLE + rf""", g AS (SELECT sha, coalesce(nullif({_CANON.format("heading")}, ''), lower(trim(regexp_replace(coalesce(heading, ''), '\s+', ' ', 'g')))) AS hkey, arg_min(coalesce(heading, chr(0)), (idx, sec, pos)) AS heading, min((idx, sec, pos)) AS place0,
  string_agg(paragraph, chr(10) || chr(10) ORDER BY idx, sec, pos) AS markdown FROM p WHERE sha IN (SELECT sha FROM w) GROUP BY 1, 2)
SELECT sha, CAST(row_number() OVER (PARTITION BY sha ORDER BY place0) AS INTEGER) AS place, nullif(heading, chr(0)) AS heading, markdown FROM g""")
def sections(spark: SparkSession, d: str) -> DataFrame:
    return A.merged_sections(A.complete_chunks(_chunks(spark, d)))


@REGISTRY.add("reassemble_entities", _C + """SELECT sha, slug, arg_min(name, (idx, pos)) AS name, arg_max(definition, (rank, length(coalesce(definition, '')), -idx, -pos)) AS definition, arg_max(salience, (rank, length(coalesce(definition, '')), -idx, -pos)) AS salience
 FROM m WHERE coalesce(slug, '') <> '' GROUP BY sha, slug""")
def entities(spark: SparkSession, d: str) -> DataFrame:
    return A.merged_entities(_chunks(spark, d)).filter("coalesce(slug, '') <> ''").select("sha", "slug", "name", "definition", "salience")


@REGISTRY.add("reassemble_relations", _C + """, r AS (SELECT sha, idx, i AS pos, relations[i] AS r FROM (SELECT *, unnest(range(1, len(relations) + 1)) AS i FROM c))
SELECT sha, r.from_slug AS from_slug, r.rel_type AS rel_type, r.to_slug AS to_slug, max(r.confidence) AS confidence FROM r GROUP BY ALL""")
def relations(spark: SparkSession, d: str) -> DataFrame:
    return A.merged_relations(_chunks(spark, d)).select("sha", "from_slug", "rel_type", "to_slug", "confidence")


@REGISTRY.add("reassemble_warnings", _C + r"""SELECT sha, count(DISTINCT lower(trim(regexp_replace(coalesce(w.text, ''), '\s+', ' ', 'g')))) AS warnings FROM (SELECT sha, unnest(note.warnings) AS w FROM c) GROUP BY sha""")
def warnings(spark: SparkSession, d: str) -> DataFrame:
    return A.merged_warnings(_chunks(spark, d)).groupBy("sha").agg(F.count("*").alias("warnings"))


@REGISTRY.add("reassemble_documents", _C + """, w AS (SELECT sha FROM c GROUP BY sha HAVING count(*) = arg_min(total, CAST(idx AS VARCHAR))), d AS (SELECT * FROM c WHERE sha IN (SELECT sha FROM w)),
 t AS (SELECT sha, count(DISTINCT tag) AS n FROM (SELECT sha, unnest(note.tags) AS tag FROM d) GROUP BY sha), q AS (SELECT sha, count(DISTINCT coalesce(nullif(e.slug, ''), e.name)) AS n FROM (SELECT sha, unnest(entities) AS e FROM d) GROUP BY sha),
 r AS (SELECT sha, count(DISTINCT (r.from_slug, r.rel_type, r.to_slug)) AS n FROM (SELECT sha, unnest(relations) AS r FROM d) GROUP BY sha), u AS (SELECT sha, sum(v) AS n FROM (SELECT sha, unnest(map_values(extraction.usage)) AS v FROM d) GROUP BY sha)
SELECT sha, CAST(count(*) AS INTEGER) AS chunks, arg_min(path, idx) AS path, arg_min(note.title, idx) AS title, least(8, coalesce(any_value(t.n), 0))::INTEGER AS tags, coalesce(any_value(q.n), 0)::INTEGER AS entities, coalesce(any_value(r.n), 0)::INTEGER AS relations, coalesce(any_value(u.n), 0)::BIGINT AS tokens
FROM d LEFT JOIN t USING (sha) LEFT JOIN q USING (sha) LEFT JOIN r USING (sha) LEFT JOIN u USING (sha) GROUP BY sha""")
def documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents: what each is made of."""
    a = A.assemble(_chunks(spark, d))
    size = lambda x: F.coalesce(F.size(x), F.lit(0))
    tokens = F.aggregate(F.map_values("usage"), F.lit(0).cast("long"), lambda t, x: t + x)
    return a.select("sha", F.col("chunks_reassembled").alias("chunks"), "path", "title", size("tags").alias("tags"), size("entities").alias("entities"), size("relations").alias("relations"), F.coalesce(tokens, F.lit(0).cast("long")).alias("tokens"))


@REGISTRY.add("usage_rollup", _C + "SELECT sha, k AS field, CAST(sum(v) AS BIGINT) AS n FROM (SELECT sha, unnest(map_keys(extraction.usage)) AS k, unnest(map_values(extraction.usage)) AS v FROM c) GROUP BY ALL")
def usage(spark: SparkSession, d: str) -> DataFrame:
    return A.usage_totals(_chunks(spark, d))


@REGISTRY.add("stale_chunks", _C + """, k AS (SELECT path, sha256, ord FROM ledger WHERE sha256 IS NOT NULL AND coalesce(path, '') <> ''), now AS (SELECT path, arg_max(sha256, ord) AS now FROM k GROUP BY path)
SELECT sha, idx, 'beyond' AS why FROM c WHERE idx >= total UNION ALL SELECT sha, idx, 'replaced' FROM c WHERE sha IN (SELECT sha256 FROM k JOIN now USING (path) WHERE sha256 <> now) AND sha NOT IN (SELECT now FROM now)""")
def stale(spark: SparkSession, d: str) -> DataFrame:
    return A.stale_chunks(_chunks(spark, d), read_table(spark, d, "ledger"))


_K = f""", k AS (SELECT DISTINCT key, slug FROM (SELECT slug AS key, slug FROM entity_page UNION ALL SELECT {_CANON.format("name")}, slug FROM entity_page
 UNION ALL SELECT {_CANON.format("a")}, slug FROM (SELECT unnest(aliases) AS a, slug FROM entity_page)) WHERE length(key) >= 2 AND slug IS NOT NULL)"""


@REGISTRY.add("entity_resolved_keys", _C + _K + " SELECT key, min(slug) AS slug FROM k GROUP BY key HAVING count(DISTINCT slug) = 1")
def resolved(spark: SparkSession, d: str) -> DataFrame:
    return G.resolved_keys(G.entity_keys(read_table(spark, d, "entity_page")))


@REGISTRY.add("entity_collisions", _C + _K + " SELECT key, count(DISTINCT slug) AS n, count(DISTINCT slug) > 5 AS large FROM k GROUP BY key HAVING count(DISTINCT slug) > 1")
def collisions(spark: SparkSession, d: str) -> DataFrame:
    return G.collisions(G.entity_keys(read_table(spark, d, "entity_page")))


@REGISTRY.add("entity_matches", _C + _K + f""", r AS (SELECT key, min(slug) AS page FROM k GROUP BY key HAVING count(DISTINCT slug) = 1),
 b AS (SELECT slug, name, list_sort(list_distinct(flatten(list(coalesce(aliases, []))))) AS a FROM m GROUP BY slug, name),
 x AS (SELECT slug, name, [slug, {_CANON.format("name")}] || list_transform(a, lambda z: {_CANON.format("z")}) AS keys FROM b),
 y AS (SELECT slug, name, unnest(keys) AS key, unnest(range(len(keys))) AS pos FROM x)
SELECT y.slug, y.name, arg_min(page, pos) AS page FROM y JOIN r USING (key) GROUP BY y.slug, y.name""")
def matches(spark: SparkSession, d: str) -> DataFrame:
    return G.match_entities(G.mentions(_env(spark, d)), G.resolved_keys(G.entity_keys(read_table(spark, d, "entity_page"))))


@REGISTRY.add("entity_registry", _C + """, a AS (SELECT slug, string_agg(x, '|' ORDER BY x) AS aliases FROM (SELECT DISTINCT slug, unnest(aliases) AS x FROM m) GROUP BY slug)
SELECT m.slug, arg_min(name, (sha, idx, pos)) AS name, coalesce(any_value(a.aliases), '') AS aliases, count(DISTINCT doc) AS docs, arg_max(salience, (rank, salience)) AS max_salience FROM m LEFT JOIN a USING (slug) WHERE coalesce(m.slug, '') <> '' GROUP BY m.slug""")
def registry(spark: SparkSession, d: str) -> DataFrame:
    return G.upsert(G.mentions(_env(spark, d))).select("slug", "name", F.array_join("aliases", "|").alias("aliases"), F.size("docs").cast("long").alias("docs"), "max_salience")


@REGISTRY.add("entity_promotion", _C + "SELECT * FROM pr")
def promotion(spark: SparkSession, d: str) -> DataFrame:
    return G.promoted(G.mentions(_env(spark, d)))


@REGISTRY.add("entity_definitions", _C + """, df AS (SELECT slug, doc, arg_min(definition, (sha, idx, pos)) AS text, arg_min(rank, (sha, idx, pos)) AS rank FROM m WHERE trim(coalesce(definition, '')) <> '' AND coalesce(slug, '') <> '' GROUP BY slug, doc)
SELECT slug, arg_min(text, (-rank, doc)) AS text FROM df GROUP BY slug""")
def definitions(spark: SparkSession, d: str) -> DataFrame:
    return G.best_definitions(G.definitions(G.mentions(_env(spark, d))))


@REGISTRY.add("entity_mentions", _C + "SELECT DISTINCT slug, doc, evidence FROM m WHERE slug IN (SELECT slug FROM pr WHERE promoted)")
def mentions(spark: SparkSession, d: str) -> DataFrame:
    m = G.mentions(_env(spark, d))
    return G.entity_mentions(m, G.promoted(m))


@REGISTRY.add("entity_sources", _C + "SELECT slug, count(DISTINCT path) AS sources FROM m WHERE slug IN (SELECT slug FROM pr WHERE promoted) GROUP BY slug")
def sources(spark: SparkSession, d: str) -> DataFrame:
    m = G.mentions(_env(spark, d))
    return G.entity_sources(m, G.promoted(m))


_R = f""", r AS (SELECT {_CANON.format("r.from_slug")} AS from_slug, r.rel_type AS rel_type, {_CANON.format("r.to_slug")} AS to_slug, r.confidence AS confidence FROM (SELECT unnest(relations) AS r FROM c)),
g AS (SELECT from_slug, rel_type, to_slug, count(*) AS n, max(confidence) AS confidence FROM r WHERE confidence >= 0.6 AND from_slug <> to_slug AND from_slug IN (SELECT slug FROM pr WHERE promoted) AND to_slug IN (SELECT slug FROM pr WHERE promoted) GROUP BY ALL)"""


@REGISTRY.add("relation_graph", _C + _R + " SELECT * FROM g")
def graph(spark: SparkSession, d: str) -> DataFrame:
    return G.relation_graph(_env(spark, d), G.promoted(G.mentions(_env(spark, d))))


@REGISTRY.add("relation_degrees", _C + _R + " SELECT slug, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) AS BIGINT) AS n_in FROM (SELECT from_slug AS slug, 1 AS o, 0 AS i FROM g UNION ALL SELECT to_slug, 0, 1 FROM g) GROUP BY slug")
def degrees(spark: SparkSession, d: str) -> DataFrame:
    return G.degrees(graph(spark, d))
