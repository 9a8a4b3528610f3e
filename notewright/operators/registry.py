"""Entities across documents: keys and their pages, the registry, promotion, mentions and relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from .reassemble import salience_rank

LEAST_CONFIDENCE, CLUSTER = 0.6, 5


def entity_keys(entity_page: DataFrame, alias_table: DataFrame | None = None) -> DataFrame:
    """(key, slug): what an entity page can be found by: its slug, name and aliases, and the rows (alias, slug) of the alias table; keys of two signs or more."""
    p = entity_page.filter("slug is not null")
    keys = F.concat(F.array("slug", X.canon(F.col("name"))), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), X.canon))
    k = p.select(F.explode(keys).alias("key"), "slug")
    if alias_table is not None:
        k = k.unionByName(alias_table.select(X.canon(F.col("alias")).alias("key"), "slug"))
    return k.filter("length(key) >= 2").distinct()


def resolved_keys(keys: DataFrame) -> DataFrame:
    """(key, slug): keys that lead to one page."""
    return keys.groupBy("key").agg(F.count_distinct("slug").alias("n"), F.min("slug").alias("slug")).filter("n = 1").select("key", "slug")


def collisions(keys: DataFrame) -> DataFrame:
    """(key, n, large): keys that lead to several pages; they match none and are only reported. ``large``: more than a cluster may have."""
    return keys.groupBy("key").agg(F.count_distinct("slug").alias("n")).filter("n > 1").withColumn("large", F.col("n") > CLUSTER)


def mentions(envelope: DataFrame) -> DataFrame:
    """One row a document chunk and entity: doc (note slug), path, day, ord and the entity's parts."""
    e = envelope.select(F.col("source.sha256").alias("sha"), F.col("source.chunk.idx").alias("idx"), F.col("source.path").alias("path"), F.col("note.slug").alias("doc"), D.note_date(F.col("note.doc_date"), F.col("extraction.extracted_at"), F.current_date()).alias("day"), F.posexplode("entities").alias("pos", "e"))
    return e.dropDuplicates(["sha", "idx", "pos"]).select("sha", "idx", "pos", "path", "doc", "day", "e.*")


def match_entities(m: DataFrame, resolved: DataFrame) -> DataFrame:
    """(slug, name, page): the page of each mentioned entity: by slug, then name, then aliases, the first key that leads to one page."""
    e = m.select("slug", "name", "aliases").groupBy("slug", "name").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("aliases", F.array().cast("array<string>")))))).alias("aliases"))
    keys = F.concat(F.array("slug", X.canon(F.col("name"))), F.transform("aliases", X.canon))
    k = e.select("slug", "name", F.posexplode(keys).alias("pos", "key")).join(resolved.withColumnRenamed("slug", "page"), "key")
    return k.groupBy("slug", "name").agg(F.min_by("page", "pos").alias("page"))


def upsert(m: DataFrame) -> DataFrame:
    """The registry by entity: name, kind and subtype of the first mention, united aliases, tags and documents, the highest salience, the first and last day."""
    at = F.struct("sha", "idx", "pos")
    m = m.filter("coalesce(slug, '') <> ''")
    # Lists are taken apart and made different before they are collected, so an entity that many documents mention holds each value once only.
    each = F.concat(*[F.transform(F.coalesce(c, F.array().cast("array<string>")), _kind(c)) for c in ("aliases", "tags")], F.array(F.struct(F.lit("docs").alias("c"), F.col("doc").alias("x"))))
    values = m.select("slug", F.explode(each).alias("v")).select("slug", "v.*").filter("x is not null").distinct()
    of = lambda c: F.array_sort(F.collect_list(F.when(F.col("c") == c, F.col("x")))).alias(c)
    lists = values.groupBy("slug").agg(of("aliases"), of("tags"), of("docs"))
    g = m.groupBy("slug").agg(
        F.min_by(F.struct("name", "kind", "subtype"), at).alias("f"),
        F.max_by("salience", F.struct(salience_rank(F.col("salience")), F.col("salience"))).alias("max_salience"),
        F.min("day").alias("first_seen"),
        F.max("day").alias("last_seen"),
    )
    none = F.array().cast("array<string>")
    return g.join(lists, "slug", "left").select("slug", "f.*", *[F.coalesce(c, none).alias(c) for c in ("aliases", "tags", "docs")], "max_salience", "first_seen", "last_seen")


def _kind(c: str):  # noqa: ANN202
    return lambda x: F.struct(F.lit(c).alias("c"), x.alias("x"))


def merge_registry(old: DataFrame, new: DataFrame) -> DataFrame:
    """The registry after new rows of the same form; what was first stays."""
    both = old.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    g = both.groupBy("slug").agg(F.min_by(F.struct("name", "kind", "subtype"), "_o").alias("f"), union("aliases").alias("aliases"), union("tags").alias("tags"), union("docs").alias("docs"), F.max_by("max_salience", F.struct(salience_rank(F.col("max_salience")), F.col("max_salience"))).alias("max_salience"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return g.select("slug", "f.*", "aliases", "tags", "docs", "max_salience", "first_seen", "last_seen")


def definitions(m: DataFrame) -> DataFrame:
    """(slug, doc, text, salience): one definition a document, the first."""
    d = m.filter("trim(coalesce(definition, '')) <> '' and coalesce(slug, '') <> ''")
    return d.groupBy("slug", "doc").agg(F.min_by(F.struct(F.col("definition").alias("text"), "salience"), F.struct("sha", "idx", "pos")).alias("d")).select("slug", "doc", "d.*")


def best_definitions(defs: DataFrame) -> DataFrame:
    """(slug, text): the most salient definition, of equal ones that of the first document."""
    return defs.groupBy("slug").agg(F.min_by("text", F.struct(-salience_rank(F.col("salience")), F.col("doc"))).alias("text"))


def promoted(m: DataFrame, *, least_docs: int = 2) -> DataFrame:
    """(slug, docs, is_primary, promoted): an entity gets a page when enough documents mention it or one makes it its subject."""
    g = m.filter("coalesce(slug, '') <> ''").groupBy("slug").agg(F.count_distinct("doc").alias("docs"), F.coalesce(F.bool_or(F.col("salience") == "primary"), F.lit(False)).alias("is_primary"))
    return g.withColumn("promoted", (F.col("docs") >= least_docs) | F.col("is_primary"))


def entity_mentions(m: DataFrame, chosen: DataFrame) -> DataFrame:
    """(slug, doc, evidence): of promoted entities, each once."""
    return m.join(chosen.filter("promoted").select("slug"), "slug", "left_semi").select("slug", "doc", "evidence").distinct()


def entity_sources(m: DataFrame, chosen: DataFrame) -> DataFrame:
    return m.join(chosen.filter("promoted").select("slug"), "slug", "left_semi").groupBy("slug").agg(F.count_distinct("path").alias("sources"))


def relation_graph(envelope: DataFrame, chosen: DataFrame, *, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """(from_slug, rel_type, to_slug, n, confidence): confident relations between two promoted entities."""
    r = envelope.select(F.col("source.sha256").alias("sha"), F.col("source.chunk.idx").alias("idx"), F.posexplode("relations").alias("pos", "r")).dropDuplicates(["sha", "idx", "pos"]).select(X.canon(F.col("r.from_slug")).alias("from_slug"), "r.rel_type", X.canon(F.col("r.to_slug")).alias("to_slug"), "r.confidence")
    p = chosen.filter("promoted").select("slug")
    r = r.filter((F.col("confidence") >= least) & (F.col("from_slug") != F.col("to_slug")))
    r = r.join(p.withColumnRenamed("slug", "from_slug"), "from_slug", "left_semi").join(p.withColumnRenamed("slug", "to_slug"), "to_slug", "left_semi")
    return r.groupBy("from_slug", "rel_type", "to_slug").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))


def degrees(graph: DataFrame) -> DataFrame:
    """(slug, n_out, n_in) over a relation graph."""
    ends = graph.select(F.explode(F.array(F.struct(F.col("from_slug").alias("slug"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("to_slug").alias("slug"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
    return ends.groupBy("x.slug").agg(F.sum("x.o").alias("n_out"), F.sum("x.i").alias("n_in"))
