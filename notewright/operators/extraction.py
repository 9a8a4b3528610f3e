"""Validation and normalisation of extractions: one projection that gives errors, warnings and the normalised record. Errors reject a record, warnings never do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X

SLUG, TAG, DATE = r"^[a-z0-9-]{1,80}\z", r"^[a-z0-9-]{1,40}\z", r"^\d{4}-\d{2}-\d{2}\z"
RESERVED = r'[/\\:*?"<>|]'
LEAST_BODY, MOST_TAGS, MOST_EVIDENCE = 200, 8, 200


def document_slugs(title: Column, path: Column) -> Column:
    """The slugs that name the document itself: of its title, its file's stem, and that without date and hash; at least eight signs long."""
    stem = X.stem_of(F.coalesce(path, F.lit("")))
    return F.filter(F.array_distinct(F.array(X.slugify(title), X.slugify(stem), X.slugify(X.bare_stem(stem)))), lambda x: F.length(x) >= 8)


def is_document(slug: Column, identity: Column, *, parts: int = 4, shared: int = 3, coverage: float = 0.5) -> Column:
    """Does a slug name the document rather than a thing in it? Equal, a long prefix either way, or most of its telling words are the document's."""
    long = F.length(slug) >= 25
    same = F.exists(identity, lambda i: (i == slug) | (long & (F.startswith(i, slug) | F.startswith(slug, i))))
    own = X.slug_parts(slug)
    theirs = F.flatten(F.transform(identity, X.slug_parts))
    common = F.size(F.filter(own, lambda x: F.array_contains(theirs, x)))
    return (F.coalesce(slug, F.lit("")) != "") & (same | ((F.size(own) >= parts) & (common >= shared) & (common / F.greatest(F.size(own), F.lit(1)) >= coverage)))


def normal_tags(tags: Column) -> Column:
    """Tags as slugs, each once, in order."""
    slugs = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: X.slugify(t, 40))
    return F.array_distinct(F.filter(slugs, lambda t: t.rlike(TAG)))


def _blank(x: Column) -> Column:
    return X.strip(F.coalesce(x, F.lit(""))) == ""


def normal_sections(sections: Column) -> Column:
    """Sections with text; one without a heading is called Resume."""
    kept = F.filter(F.coalesce(sections, F.array().cast("array<struct<heading:string,markdown:string>>")), lambda s: ~_blank(s.markdown))
    return F.transform(kept, lambda s: F.struct(F.when(_blank(s.heading), F.lit("Resume")).otherwise(s.heading).alias("heading"), s.markdown.alias("markdown")))


def normal_slug(slug: Column, fallback: Column) -> Column:
    """A slug that fits, else the one made of it or of the fallback; null where none can be made."""
    s = X.strip(F.coalesce(slug, F.lit("")))
    made = X.slugify(F.when(s != "", s).otherwise(fallback))
    return F.when(s.rlike(SLUG), s).otherwise(F.nullif(made, F.lit("")))


def normal_entities(entities: Column, identity: Column) -> Column:
    """Entities that have a name and a slug, are not the document and carry no date; the first of a slug wins."""

    def clean(e: Column) -> Column:
        name = F.regexp_replace(X.strip(F.coalesce(e["name"], F.lit(""))), RESERVED, "-")
        return F.struct(
            normal_slug(e.slug, name).alias("slug"),
            X.strip(name).alias("name"),
            F.when(e.kind.isin("entity", "concept"), e.kind).otherwise(F.lit("entity")).alias("kind"),
            e.subtype.alias("subtype"),
            F.filter(F.transform(F.coalesce(e.aliases, F.array().cast("array<string>")), X.strip), lambda a: a != "").alias("aliases"),
            F.array_distinct(F.filter(F.transform(F.coalesce(e.tags, F.array().cast("array<string>")), lambda t: X.slugify(t, 40)), lambda t: t != "")).alias("tags"),
            e.definition.alias("definition"),
            F.left(e.evidence, F.lit(MOST_EVIDENCE)).alias("evidence"),
            F.when(e.salience.isin("primary", "secondary", "passing"), e.salience).otherwise(F.lit("passing")).alias("salience"),
        )

    good = F.filter(F.transform(F.filter(entities, lambda e: e.isNotNull()), clean), lambda e: (e["name"] != "") & e.slug.isNotNull() & ~is_document(e.slug, identity) & ~e.slug.rlike(r"\d{4}-\d{2}-\d{2}"))
    slugs = F.transform(good, lambda e: e.slug)
    return F.filter(good, lambda e, i: F.array_position(slugs, e.slug) == i + 1)


def normal_relations(relations: Column, slugs: Column) -> Column:
    """Relations between two different entities of the record, confidence within 0 and 1, 0.5 where it is none."""
    ends = F.transform(relations, lambda r: F.struct(X.strip(F.coalesce(r.from_slug, F.lit(""))).alias("from_slug"), X.strip(F.coalesce(r.to_slug, F.lit(""))).alias("to_slug"), r.rel_type.alias("rel_type"), r.evidence.alias("evidence"), N.clamp_share(r.confidence, 0.5).alias("confidence")))
    return F.filter(ends, lambda r: F.array_contains(slugs, r.from_slug) & F.array_contains(slugs, r.to_slug) & (r.from_slug != r.to_slug))


def validate(envelope: DataFrame) -> DataFrame:
    """Key, errors, warnings and the normalised parts of each extraction."""
    e = envelope.select(F.col("source.sha256").alias("sha256"), F.col("source.chunk.idx").alias("chunk_idx"), F.col("source.path").alias("path"), "note", "entities", "relations", "extraction")
    title = X.strip(F.coalesce("note.title", F.lit("")))
    e = e.withColumns({"title": title, "slug": normal_slug(F.col("note.slug"), title), "sections": normal_sections(F.col("note.sections")), "tags": normal_tags(F.col("note.tags")), "identity": document_slugs(title, F.col("path"))})
    e = e.withColumn("good", normal_entities(F.coalesce("entities", F.array().cast(envelope.schema["entities"].dataType)), F.col("identity")))
    slugs = F.transform("good", lambda x: x.slug)
    e = e.withColumn("kept_relations", normal_relations(F.coalesce("relations", F.array().cast(envelope.schema["relations"].dataType)), slugs))
    body = F.aggregate(F.transform("sections", lambda s: F.length(X.strip(s.markdown))), F.lit(0), lambda a, x: a + x)
    tokens = F.array_distinct(F.flatten(F.transform("sections", lambda s: F.regexp_extract_all(s.markdown, F.lit(r"\{\{E:([^}]{1,120})\}\}"), F.lit(1)))))
    told = lambda cond, name: F.when(cond, F.lit(name))
    day = X.strip(F.coalesce("note.doc_date", F.lit("")))
    errors = F.array_compact(F.array(told(F.col("title") == "", "title"), told(F.col("slug").isNull(), "slug"), told(F.size("sections") == 0, "sections"), told(body < LEAST_BODY, "body"), told(F.size("tags") == 0, "tags")))
    size = lambda c: F.greatest(F.size(F.coalesce(c, F.array())), F.lit(0))
    warnings = F.array_compact(
        F.array(
            told(_blank(F.col("note.summary")), "summary"),
            told(F.size("tags") != size(F.col("note.tags")), "tags"),
            told((day != "") & ~day.rlike(DATE), "doc_date"),
            told(F.size("good") != size(F.col("entities")), "entities"),
            told(F.size(F.array_except(tokens, slugs)) > 0, "tokens"),
            told(F.exists("sections", lambda s: F.contains(s.markdown, F.lit("[["))), "wikilink"),
            told(F.size("kept_relations") != size(F.col("relations")), "relations"),
            told(F.exists(F.coalesce("note.warnings", F.array().cast("array<struct<kind:string,about:string,text:string>>")), lambda w: (F.coalesce(w.about, F.lit("")) != "") & ~F.array_contains(slugs, w.about)), "about"),
            told(F.col("extraction.confidence").isNull(), "confidence"),
        )
    )
    return e.select("sha256", "chunk_idx", errors.alias("errors"), warnings.alias("warnings"), "title", "slug", F.slice("tags", 1, MOST_TAGS).alias("tags"), bare_tokens(F.col("sections"), slugs).alias("sections"), F.col("good").alias("entities"), F.col("kept_relations").alias("relations"), F.when(day.rlike(DATE), day).alias("doc_date"), N.clamp_share(F.col("extraction.confidence"), 0.0).alias("confidence"))


def bare_tokens(sections: Column, slugs: Column) -> Column:
    """Sections with tokens of unknown entities as plain words."""
    known = lambda t: F.when(F.array_contains(slugs, t), F.concat(F.lit("{{E:"), t, F.lit("}}"))).otherwise(F.replace(t, F.lit("-"), F.lit(" ")))
    return F.transform(sections, lambda s: F.struct(s.heading.alias("heading"), X.replace_tokens(s.markdown, r"\{\{E:([^}]{1,120})\}\}", known).alias("markdown")))
