"""Putting the chunks of a document together again. Groups are documents (sha256); what is collected in one is bounded by its chunks.

Chunks are counted once each, in the order of ``idx``; the first wins wherever one must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

RANK = {"passing": 0, "secondary": 1, "primary": 2}


def salience_rank(salience: Column) -> Column:
    out = F.lit(0)
    for k, v in RANK.items():
        out = F.when(salience == k, v).otherwise(out)
    return out


def chunks(envelope: DataFrame) -> DataFrame:
    """One row a chunk: sha, idx, total and the parts; deliveries of the same chunk count once."""
    c = envelope.select(F.col("source.sha256").alias("sha"), F.col("source.chunk.idx").alias("idx"), F.col("source.chunk.total").alias("total"), "note", "entities", "relations", "issues", F.col("extraction.usage").alias("usage"), F.col("source.path").alias("path"), F.col("extraction.extracted_at").alias("extracted_at"))
    return c.dropDuplicates(["sha", "idx"])


def completeness(c: DataFrame) -> DataFrame:
    """(sha, chunks, total, complete): a document is complete when it has as many chunks as its first one, by file name, says."""
    g = c.groupBy("sha").agg(F.count("*").alias("chunks"), F.min_by("total", F.col("idx").cast("string")).alias("total"))
    return g.withColumn("complete", F.col("chunks") == F.col("total"))


def complete_chunks(c: DataFrame) -> DataFrame:
    return c.join(completeness(c).filter("complete").select("sha"), "sha", "left_semi")


def top_tags(c: DataFrame, *, most: int = 8) -> DataFrame:
    """(sha, tag, n, place): the most frequent tags, equal ones by name."""
    n = c.select("sha", F.explode("note.tags").alias("tag")).groupBy("sha", "tag").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("sha").orderBy(F.desc("n"), "tag"))).filter(F.col("place") <= most)


def summaries(c: DataFrame) -> DataFrame:
    """(sha, summary): of up to three chunks the different summaries joined; of more the first, with the number of parts."""
    s = c.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("idx", F.col("note.summary").alias("s")))).alias("all"), F.count("*").alias("n"))
    texts = F.filter(F.transform("all", lambda x: X.strip(F.coalesce(x.s, F.lit("")))), lambda x: x != "")
    keys = F.transform(texts, X.paragraph_key)
    first = F.filter(texts, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)
    return s.select("sha", F.when(F.col("n") <= 3, F.array_join(first, " ")).otherwise(F.concat(F.coalesce(F.try_element_at(texts, F.lit(1)), F.lit("")), F.lit(" (document en "), F.col("n").cast("string"), F.lit(" parties)"))).alias("summary"))


def paragraphs(c: DataFrame) -> DataFrame:
    """(sha, idx, sec, pos, heading, paragraph): each paragraph at its first place in the document."""
    p = c.select("sha", "idx", F.posexplode("note.sections").alias("sec", "s")).select("sha", "idx", "sec", F.col("s.heading").alias("heading"), F.posexplode(F.split("s.markdown", r"\n\s*\n")).alias("pos", "paragraph"))
    p = p.withColumn("key", X.paragraph_key(F.col("paragraph"))).filter("key <> ''")
    first = Window.partitionBy("sha", F.xxhash64("key"), "key").orderBy("idx", "sec", "pos")
    return p.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n", "key")


def merged_sections(c: DataFrame) -> DataFrame:
    """(sha, place, heading, markdown): sections of one heading together, in order of appearance, without repeated paragraphs."""
    p = paragraphs(c).withColumn("canon", X.canon(F.col("heading")))
    p = p.withColumn("hkey", F.when(F.col("canon") != "", F.col("canon")).otherwise(X.paragraph_key(F.coalesce("heading", F.lit("")))))
    at = F.struct("idx", "sec", "pos")
    g = p.groupBy("sha", "hkey").agg(F.min(at).alias("at"), F.min_by("heading", at).alias("heading"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "sec", "pos", "paragraph"))), lambda x: x.paragraph), "\n\n").alias("markdown"))
    return g.withColumn("place", F.row_number().over(Window.partitionBy("sha").orderBy("at"))).select("sha", "place", "heading", "markdown")


def merged_entities(c: DataFrame) -> DataFrame:
    """(sha, slug, name, kind, subtype, aliases, tags, definition, evidence, salience): the first mention is the base; definition, evidence and salience come from the
    most salient mention, then the longest definition; aliases and tags are united."""
    e = c.select("sha", "idx", F.posexplode("entities").alias("pos", "e")).withColumn("key", F.coalesce(F.nullif("e.slug", F.lit("")), "e.name"))
    at = F.struct("idx", "pos")
    best = F.struct(salience_rank(F.col("e.salience")), F.length(F.coalesce("e.definition", F.lit(""))), -F.col("idx"), -F.col("pos"))
    union = lambda f: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(f"e.{f}", F.array().cast("array<string>"))))))
    g = e.groupBy("sha", "key").agg(F.min_by("e", at).alias("b"), F.max_by(F.struct("e.definition", "e.evidence", "e.salience"), best).alias("d"), union("aliases").alias("aliases"), union("tags").alias("tags"), F.min_by("e.subtype", F.when(F.coalesce("e.subtype", F.lit("")) != "", at)).alias("subtype"))
    return g.select("sha", F.col("b.slug").alias("slug"), F.col("b.name").alias("name"), F.col("b.kind").alias("kind"), "subtype", "aliases", "tags", "d.definition", "d.evidence", "d.salience")


def merged_relations(c: DataFrame) -> DataFrame:
    """(sha, from_slug, rel_type, to_slug, confidence, evidence): the most confident of each, the first of equal ones."""
    r = c.select("sha", "idx", F.posexplode("relations").alias("pos", "r")).select("sha", "idx", "pos", "r.*")
    best = F.struct(F.coalesce("confidence", F.lit(-1.0)), -F.col("idx"), -F.col("pos"))
    return r.groupBy("sha", "from_slug", "rel_type", "to_slug").agg(F.max_by(F.struct("confidence", "evidence"), best).alias("b")).select("sha", "from_slug", "rel_type", "to_slug", "b.*")


def merged_warnings(c: DataFrame) -> DataFrame:
    """(sha, at, kind, about, text): warnings whose text was not there before, with their place."""
    w = c.select("sha", "idx", F.posexplode("note.warnings").alias("pos", "w")).withColumn("key", X.paragraph_key(F.coalesce("w.text", F.lit(""))))
    return w.groupBy("sha", "key").agg(F.min(F.struct("idx", "pos")).alias("at"), F.min_by("w", F.struct("idx", "pos")).alias("w")).select("sha", "at", "w.*")


def merged_issues(c: DataFrame) -> DataFrame:
    """(sha, at, code, detail): issues, each once, at their first place."""
    i = c.select("sha", "idx", F.posexplode("issues").alias("pos", "i"))
    return i.groupBy("sha", "i").agg(F.min(F.struct("idx", "pos")).alias("at")).select("sha", "at", "i.*")


def assemble(c: DataFrame) -> DataFrame:
    """One row a complete document: sha, path, chunk (0, n), chunks_reassembled, title, slug, doc_date and summary, tags, sections, warnings, entities, relations,
    issues, usage. Parts are merged apart, each grouped by document, and joined by it, so no row holds more than one document's."""
    whole = complete_chunks(c)
    first = lambda f: F.min_by(F.col(f), "idx").alias(f.split(".")[-1])
    head = whole.groupBy("sha").agg(F.count("*").cast("int").alias("n"), first("path"), first("note.title"), first("note.slug"), F.min_by("note.doc_date", F.when(F.coalesce("note.doc_date", F.lit("")) != "", F.col("idx"))).alias("doc_date"))
    listed = lambda df, by, name: df.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct(*by, *[x for x in df.columns if x not in ("sha", *by)]))).alias(name))
    usage = usage_totals(whole).groupBy("sha").agg(F.map_from_entries(F.collect_list(F.struct("field", "n"))).alias("usage"))
    parts = [summaries(whole), listed(top_tags(whole), ["place"], "tags"), listed(merged_sections(whole), ["place"], "sections"), listed(merged_warnings(whole), ["at"], "warnings"), listed(merged_entities(whole), ["slug"], "entities"), listed(merged_relations(whole), ["from_slug", "rel_type", "to_slug"], "relations"), listed(merged_issues(whole), ["at"], "issues"), usage]
    out = head
    for p in parts:
        out = out.join(p, "sha", "left")
    return out.withColumn("chunk", F.struct(F.lit(0).alias("idx"), F.col("n").alias("total"))).withColumnRenamed("n", "chunks_reassembled")


def usage_totals(c: DataFrame) -> DataFrame:
    """(sha, field, n): tokens used by field over the chunks."""
    return c.select("sha", F.explode("usage").alias("field", "n")).groupBy("sha", "field").agg(F.sum("n").alias("n"))


def stale_chunks(c: DataFrame, ledger: DataFrame) -> DataFrame:
    """(sha, idx, why): chunks to delete: beyond the number of chunks of their document, or of a content that its path had before."""
    beyond = c.filter("idx >= total").select("sha", "idx", F.lit("beyond").alias("why"))
    known = ledger.filter("sha256 is not null and coalesce(path, '') <> ''")
    now = known.groupBy("path").agg(F.max_by("sha256", "ord").alias("now"))
    old = known.join(now, "path").filter("sha256 <> now").select(F.col("sha256").alias("sha")).distinct().join(now.select(F.col("now").alias("sha")).distinct(), "sha", "left_anti")
    return beyond.unionByName(c.join(old, "sha", "left_semi").select("sha", "idx", F.lit("replaced").alias("why")))
