"""The extraction job: notes become spans, spans become requests, an injected extractor answers, answers become validated envelopes and ledger lines.

Nothing here knows a service. An extractor is a function from a request (JSON) to a response (JSON with ``status`` and ``text``); it is shipped to the executors and called in
Arrow batches, one span at a time. The default one is deterministic and works offline.

Defined results: spans that the spool already has, with the same number of chunks, are left out; an answer that is no JSON object is an error of its span; a call
cap leaves spans for the next run; empty notes have no span.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from .chunking import document_spans

#: What an answer holds. Fixed value.
RESPONSE = (
    "note struct<slug:string,title:string,tags:array<string>,doc_date:string,summary:string,sections:array<struct<heading:string,markdown:string>>,warnings:array<struct<kind:string,about:string,text:string>>>, "
    "entities array<struct<slug:string,name:string,kind:string,subtype:string,aliases:array<string>,tags:array<string>,definition:string,evidence:string,salience:string>>, "
    "relations array<struct<from_slug:string,to_slug:string,rel_type:string,evidence:string,confidence:double>>, "
    "issues array<struct<code:string,detail:string>>, language string, confidence double"
)
Extractor = Callable[[dict], dict]


def nonce(sha: Column, changed_ns: Column) -> Column:
    """What marks the document's limits in a prompt: twelve signs that a document cannot foresee."""
    return F.left(F.sha2(F.concat_ws("|", sha, changed_ns.cast("string")), 256), F.lit(12))


def prompt(content: Column, mark: Column, name: Column, instructions: str) -> Column:
    """The instructions, the same for all; the document between its marks; the file's name last."""
    return F.concat(F.lit(instructions + "\n\n<document "), mark, F.lit(">\n"), content, F.lit("\n</document "), mark, F.lit(">\n\n"), name)


def payload(text: Column, *, schema: str | None = None, temperature: float | None = None, thinking: Column | None = None) -> Column:
    """A request as JSON; blocks that are not asked for are left out."""
    given = [F.lit(schema).alias("response_schema"), F.lit(temperature).alias("temperature"), (F.lit(None).cast("string") if thinking is None else thinking).alias("thinking_level")]
    return F.to_json(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("contents"), F.struct(*given).alias("config")))


def thinking_config(model: Column, families: dict[str, str]) -> Column:
    """The thinking level of the longest family name that the model's begins with; null for others."""
    out = F.lit(None).cast("string")
    for prefix in sorted(families, key=len):
        out = F.when(F.startswith(model, F.lit(prefix)), F.lit(families[prefix])).otherwise(out)
    return out


def thinking_rejected(code: Column, body: Column) -> Column:
    """Was a request refused for its thinking level? Then a milder one is asked for."""
    return (code == 400) & F.contains(F.lower(F.coalesce(body, F.lit(""))), F.lit("thinking level"))


def offline(request: dict) -> dict:
    """An extractor without a service: the document's first heading is its title, its paragraphs one section, capitalised words that recur its entities."""
    text = re.search(r"<document \w+>\n(.*)\n</document \w+>", request["contents"]["parts"][0]["text"], re.S)
    body = text[1] if text else ""
    head = re.search(r"^#+ +(.+)$", body, re.M)
    title = (head[1] if head else body.strip().split("\n")[0])[:120].strip() or "sans titre"
    names = re.findall(r"(?<=[\w,;] )[A-ZÀ-Þ][\w-]{2,}", body)
    often = sorted({n for n in names if names.count(n) > 1}) if len(names) < 2_000 else []
    slug = lambda s: re.sub(r"[^a-z0-9]+", "-", s.lower()).strip("-")
    note = {"slug": slug(title)[:80], "title": title, "tags": ["imported"], "doc_date": None, "summary": body.strip()[:200], "sections": [{"heading": "Resume", "markdown": body.strip()}], "warnings": []}
    ents = [{"slug": slug(n), "name": n, "kind": "entity", "aliases": [], "tags": [], "salience": "passing"} for n in often]
    return {"status": "ok", "text": json.dumps({"note": note, "entities": ents, "relations": [], "issues": [], "language": "fr", "confidence": 0.5}, ensure_ascii=False)}


def spans_of(notes: DataFrame, threshold: Column) -> DataFrame:
    """(path, sha256, size, changed_ns, idx, total, content): the spans of each note (path, sha256, size, changed_ns, text), one where it is not longer than the threshold
    in tokens, else such as ``chunk_sizes`` plans for its own rate of tokens."""
    n = notes.filter(F.length("text") > 0).withColumn("t", N.estimated_tokens(F.col("text")))
    sizes = N.chunk_sizes(F.col("t"), F.length("text"), threshold)
    n = n.withColumn("size_chars", F.when(F.col("t") <= threshold, F.length("text")).otherwise(sizes["target_chars"])).withColumn("over", F.when(F.col("t") <= threshold, 0).otherwise(sizes["overlap_chars"]))
    s = document_spans(n, "path", "text", F.col("size_chars"), F.col("over"))
    total = s.groupBy("path").agg(F.count("*").cast("int").alias("total"))
    cut = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))
    return s.join(total, "path").join(n.select("path", "sha256", "size", "changed_ns", "text"), "path").select("path", "sha256", "size", "changed_ns", "idx", "total", cut.alias("content"))


def to_do(spans: DataFrame, spool: DataFrame, *, most_calls: int | None = None) -> DataFrame:
    """The spans that the spool (sha256, idx, total) does not have, at most ``most_calls`` of them."""
    left = spans.join(spool.select("sha256", "idx", "total").distinct(), ["sha256", "idx", "total"], "left_anti")
    return left if most_calls is None else left.limit(most_calls)


def answers(spans: DataFrame, model: str, instructions: str, *, extractor: Extractor = offline, schema: str | None = None) -> DataFrame:
    """Each span with ``status`` and ``text`` of the extractor's answer; an extractor that fails is an ``http_error`` of its span, not of the job."""
    request = payload(prompt(F.col("content"), nonce(F.col("sha256"), F.col("changed_ns")), F.substring_index("path", "/", -1), instructions), schema=schema)
    src = spans.withColumn("request", request).drop("content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            status, text = [], []
            for r in b.column("request").to_pylist():
                try:
                    a = extractor(json.loads(r))
                    status.append(str(a.get("status", "invalid")))
                    text.append(a.get("text"))
                except Exception as e:  # noqa: BLE001
                    status.append("http_error")
                    text.append(str(e))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names if c != "request"], pa.array(status, pa.string()), pa.array(text, pa.string())], [*[c for c in b.schema.names if c != "request"], "status", "text"])

    kept = ", ".join(f"{n} {t}" for n, t in src.dtypes if n != "request")
    return src.mapInArrow(run, f"{kept}, status string, text string").withColumn("model", F.lit(model))


def envelopes(answered: DataFrame, at: Column) -> DataFrame:
    """The answers that are JSON objects as envelopes: source, extraction, note, entities, relations, issues."""
    good = answered.filter((F.col("status") == "ok") & F.startswith(X.strip(F.coalesce("text", F.lit(""))), F.lit("{")) & F.try_parse_json("text").isNotNull())
    r = good.withColumn("r", F.from_json("text", RESPONSE))
    none = F.array().cast("array<string>")
    source = F.struct("path", "sha256", F.col("size").cast("bigint").alias("size"), F.struct(F.col("idx").cast("int").alias("idx"), F.col("total").cast("int").alias("total")).alias("chunk"))
    extraction = F.struct("model", at.alias("extracted_at"), F.col("r.confidence").alias("confidence"), F.col("r.language").alias("language"), F.create_map().cast("map<string,bigint>").alias("usage"), none.alias("validation_warnings"), F.lit(None).cast("int").alias("chunks_reassembled"))
    return r.select(F.lit(3).alias("schema_version"), source.alias("source"), extraction.alias("extraction"), "r.note", "r.entities", "r.relations", "r.issues")


def ledger_rows(answered: DataFrame, validated: DataFrame) -> DataFrame:
    """A ledger row a note: extracted when all its spans are answered and valid, else failed with the reason of the first span that is not. ``validated``: sha256,
    chunk_idx, errors."""
    v = validated.select("sha256", F.col("chunk_idx").alias("idx"), (F.size("errors") == 0).alias("valid"))
    j = answered.select("path", "sha256", "size", "idx", "total", "status", "model").join(v, ["sha256", "idx"], "left")
    bad = F.when(F.col("status") != "ok", F.when(F.col("status") == "truncated", "output_truncated").when(F.col("status") == "invalid", "api_invalid").otherwise(F.col("status"))).when(~F.coalesce("valid", F.lit(False)), F.lit("extract_invalid"))
    g = j.groupBy("path", "sha256").agg(F.max("size").alias("size"), F.first("model").alias("model"), F.max("total").alias("total"), F.count_if(bad.isNull()).cast("int").alias("done"), F.min_by(bad, F.when(bad.isNotNull(), F.col("idx"))).alias("reason"))
    done = F.col("done") == F.col("total")
    return g.select("path", "sha256", "size", F.when(done, "extracted").otherwise("failed").alias("status"), F.when(~done, F.coalesce("reason", F.lit("incomplete"))).alias("reason"), "model", F.struct("total", "done").alias("chunks"))
