"""File sources: raw notes, pages, the ledger's lines, extraction spool, alias table, curated index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as X

LEDGER = T.StructType(
    [
        T.StructField("schema", T.IntegerType()), T.StructField("path", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("size", T.LongType()), T.StructField("mtime", T.LongType()),
        T.StructField("ingested_at", T.StringType()), T.StructField("phase", T.StringType()), T.StructField("status", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("attempts", T.IntegerType()),
        T.StructField("model", T.StringType()), T.StructField("duration_s", T.DoubleType()), T.StructField("chunks", T.StructType([T.StructField("total", T.IntegerType()), T.StructField("done", T.IntegerType())])),
        T.StructField("produced", T.ArrayType(T.StringType())),
    ]
)


def raw_files(spark: SparkSession, root: str, *, suffixes: tuple[str, ...] = (".md", ".txt"), any_case: bool = True) -> DataFrame:
    """(path, modificationTime, length, content) of the notes under a folder, but for folders called assets below its own."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    pattern = ("(?i)" if any_case else "") + "(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + r")\z"
    inner = F.regexp_replace("path", "^.*?" + root.rstrip("/").split("/")[-1] + "/", "")
    return f.filter(F.col("path").rlike(pattern) & ~inner.rlike(r".+/assets/"))


def file_digests(files: DataFrame, known: DataFrame) -> DataFrame:
    """(path, length, sha256): files are digested only where the ledger knows their path; the others need no comparison."""
    j = files.join(known.select("path", F.lit(True).alias("known")).distinct(), "path", "left")
    return j.select("path", "length", F.when(F.col("known"), F.sha2("content", 256)).alias("sha256"))


def file_counts(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.count_if(F.lower("path").rlike(r"\.(?:md|txt|docx)$")).alias("eligible"))


def text_of(content):  # noqa: ANN001, ANN201
    """A file's bytes as text; what is no UTF-8 becomes replacement characters."""
    return F.make_valid_utf8(content.cast("string"))


def pages(spark: SparkSession, wiki: str) -> DataFrame:
    """(sub, name, stem, text, fm, body, prose, err) of the pages in the folders of a wiki."""
    f = spark.read.format("binaryFile").load([f"{wiki}/{s}" for s in ("sources", "entities", "concepts")])
    parts = F.split("path", "/")
    p = f.select(F.element_at(parts, -2).alias("sub"), F.element_at(parts, -1).alias("name"), text_of(F.col("content")).alias("text"))
    p = p.withColumn("r", X.front_matter(F.replace("text", F.lit("\r\n"), F.lit("\n"))))
    return p.select("sub", "name", F.regexp_replace("name", r"\.md$", "").alias("stem"), "text", "r.fm", "r.body", X.strip_code(F.col("r.body")).alias("prose"), "r.err")


def ledger_lines(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows with their order; blank lines, bad JSON and bare values are skipped, a line that is only a path is a row of schema 1."""
    t = spark.read.format("binaryFile").load(path).select(F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("ord", "line"))
    t = t.filter(F.trim("line") != "")
    obj = F.startswith(F.trim("line"), F.lit("{"))
    j = t.withColumn("ok", F.try_parse_json("line").isNotNull()).filter((obj & F.col("ok")) | ~obj & F.startswith("line", F.lit("/")))
    r = j.withColumn("r", F.when(obj, F.from_json("line", LEDGER)))
    return r.select(*[(F.coalesce(F.col(f"r.{n}"), F.when(~obj, F.lit(1) if n == "schema" else F.trim("line"))) if n in ("schema", "path") else F.col(f"r.{n}")).alias("schema_version" if n == "schema" else n) for n in LEDGER.names], F.col("ord").cast("long").alias("ord")).filter("coalesce(path, '') <> ''")


def spool(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The extractions of a spool folder; unreadable files are dropped."""
    s = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    j = f.select("path", F.from_json(F.col("content").cast("string"), s, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}).alias("r"))
    return j.filter("r is not null and r._corrupt is null").select("path", *[F.col(f"r.{n}") for n in schema.names])


def alias_table(spark: SparkSession, path: str) -> DataFrame:
    """(alias, slug) of lines 'alias: slug'; '#' begins a comment, the last of repeated aliases counts."""
    t = spark.read.format("binaryFile").load(path).select(F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("ord", "line"))
    bare = F.regexp_replace("line", "#.*$", "")
    kv = t.filter(F.contains(bare, F.lit(":"))).select("ord", X.strip(F.regexp_extract(bare, "^([^:]*):(.*)$", 1)).alias("alias"), X.strip(F.regexp_extract(bare, "^([^:]*):(.*)$", 2)).alias("slug"))
    return kv.filter("alias <> '' and slug <> ''").groupBy("alias").agg(F.max_by("slug", "ord").alias("slug"))


def curated_index(text: DataFrame) -> DataFrame:
    """(section, ord, target) of an index text (column ``text``): the first link of each line under its '## ' heading; links before any heading are dropped."""
    t = text.select(F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    head = F.when(F.startswith("line", F.lit("## ")), F.lower(X.strip(F.substring("line", 4, 1 << 20))))
    w = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)  # the lines of one curated file
    s = t.withColumn("section", F.last(head, ignorenulls=True).over(w)).withColumn("target", X.strip(F.regexp_extract("line", X.WIKILINK, 1)))
    return s.filter("section is not null and target <> ''").select("section", "ord", "target")


def listed_files(spark: SparkSession, path: str, there: DataFrame | None = None) -> DataFrame:
    """(path): the files that a list names, one a line; blank lines and comments do not count, nor, with a listing (path), what is not there."""
    t = spark.read.text(path).select(F.trim("value").alias("path"))
    t = t.filter(~F.startswith("path", F.lit("#")) & (F.col("path") != "")).distinct()
    return t if there is None else t.join(there.select("path"), "path", "left_semi")


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of every file under a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")


def processing_order(files: DataFrame, *, first: str = "", most: int | None = None) -> DataFrame:
    """Files (path, length, …) in the order of processing: those whose path contains ``first``, then the small ones, then by path; with ``most`` only so many."""
    out = files.orderBy(F.when(F.contains("path", F.lit(first)), 0).otherwise(1) if first else F.lit(0), "length", "path")
    return out if most is None else out.limit(most)


def eligible_notes(spark: SparkSession, root: str, settled: DataFrame, *, most: int | None = None) -> DataFrame:
    """The notes (md, txt, docx by exact suffix) that the ledger has not settled (path), at most ``most`` of them, in any order."""
    left = raw_files(spark, root, suffixes=(".md", ".txt", ".docx"), any_case=False).select("path", "length", "modificationTime").join(settled.select("path").distinct(), "path", "left_anti")
    return left if most is None else left.limit(most)


REGISTRY = (
    "key string, name string, kind string, subtype string, aliases array<string>, tags array<string>, docs array<string>, max_salience string, "
    "definitions array<struct<doc:string,text:string,salience:string>>, first_seen string, last_seen string, promoted_at string"
)


def registry_file(spark: SparkSession, path: str) -> DataFrame:
    """The registry of entities, one JSON object of records by key; empty where the file is missing or cannot be read."""
    value = T._parse_datatype_string(REGISTRY)
    empty = spark.createDataFrame([], REGISTRY)
    try:
        text = spark.read.format("binaryFile").load(path).select(F.decode("content", "UTF-8").alias("text"))
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return empty
        raise
    record = T.StructType([f for f in value.fields if f.name != "key"])
    rows = text.filter(F.try_parse_json("text").isNotNull()).select(F.explode(F.from_json("text", T.MapType(T.StringType(), record))).alias("key", "r"))
    return rows.select("key", *[F.col(f"r.{n}") for n in record.names])


def spool_files(spark: SparkSession, root: str, *, keep: int = 200, take: int = 20) -> DataFrame:
    """(path, length, modificationTime, content, purge, turn): the messages of a flat spool folder. ``purge`` marks all but the ``keep`` newest, ``turn`` numbers the
    others from the oldest; a run takes the first ``take``. The folder holds what waits for one run, not a corpus."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)
    newest = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("modificationTime"), F.desc("path")))
    marked = f.withColumn("purge", newest > keep)
    turn = F.row_number().over(Window.partitionBy("purge").orderBy("modificationTime", "path"))
    return marked.withColumn("turn", F.when(~F.col("purge"), turn)).withColumn("taken", F.coalesce(F.col("turn") <= take, F.lit(False)))


def spool_messages(files: DataFrame) -> DataFrame:
    """(path, emoji, text, persist, attach) of the spool files that are taken and fit to send: at most 65,536 bytes, JSON, with text."""
    fit = files.filter(F.col("taken") & (F.col("length") <= 65_536)).withColumn("raw", F.make_valid_utf8(F.col("content").cast("string"))).filter(F.try_parse_json("raw").isNotNull())
    m = fit.select("path", "turn", F.from_json("raw", "emoji string, text string, persist int, attach string").alias("m")).select("path", "turn", "m.*")
    return m.filter(X.strip(F.coalesce("text", F.lit(""))) != "").orderBy("turn").drop("turn")
