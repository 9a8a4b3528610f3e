"""References to records that do not exist (problem 1).

Parents (records with a key and a lifetime) are range-partitioned by the 64-bit hash of their key and stored, one row a range, as arrays sorted by
(hash, key, time). References are routed to the same ranges and probed against the arrays in Arrow batches by binary search.

A parent is alive at ``t`` when ``created <= t`` and (``deleted`` is null or ``t < deleted``). For one key the number of live parents at ``t`` is
(creations up to t) - (deletions up to t), so a range needs no list of intervals, only a running sum over its sorted events.

Skew. A range holds about ``events_per_range`` events, as ranges are cut in hash space. A key with more events than that gets ranges of its own, cut by
time at its quantiles; each carries the sums of the earlier ones. A range that many references hit is copied to as many tasks as
``refs_per_task`` asks for, and its references are spread over the copies. The number of tasks follows from all references, so a task stays within
``refs_per_task`` or little more at any size. Nothing is broadcast or collected; tasks stream their references.

Defined results. Null parent keys and null or empty lifetimes are no parents. A null reference key is reported as ``missing``; a null time as ``no_time``.
Repeated parents count as one live parent or more, which is the same. Empty tables give no parents or no rows. Extra columns of the references pass
through under their own names, whatever these are. Equal references each give their row; use ``distinct`` before where copies count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import written

#: What a reference's parent was at the time of the reference.
REASONS = ("ok", "missing", "not_yet", "deleted", "no_time")
_EVENT = "array<struct<h:bigint,key:string,t:bigint,net:bigint,made:bigint>>"


def parent_events(parents: DataFrame, key: Column, created: Column, deleted: Column) -> DataFrame:
    """(h, key, t, net, made): by key and instant, creations less deletions, and creations."""
    p = parents.select(key.alias("key"), F.unix_micros(created.cast("timestamp")).alias("c"), F.unix_micros(deleted.cast("timestamp")).alias("d"))
    p = p.filter("key is not null and c is not null and (d is null or d > c)")
    steps = F.filter(F.array(F.struct(F.col("c").alias("t"), F.lit(1).cast("long").alias("net"), F.lit(1).cast("long").alias("made")), F.struct(F.col("d").alias("t"), F.lit(-1).cast("long").alias("net"), F.lit(0).cast("long").alias("made"))), lambda s: s.t.isNotNull())
    e = p.select("key", F.explode(steps).alias("e")).select("key", "e.*")
    return e.groupBy("key", "t").agg(F.sum("net").alias("net"), F.sum("made").alias("made")).select(F.xxhash64("key").alias("h"), "key", "t", "net", "made")


def _range_of(h: str, n: int) -> Column:
    """The number of the range of a hash, of ``n`` equal ranges of hash space."""
    return F.least(F.floor((F.col(h).cast("double") / F.lit(2.0**64) + 0.5) * n), F.lit(n - 1)).cast("long")


def _slot(t: str, cuts: str) -> Column:
    """The number of cuts that are at or before t."""
    return F.size(F.filter(F.col(cuts), lambda c: c <= F.col(t))).cast("long")


def parent_arrays(events: DataFrame, ranges: int, hot: DataFrame | None) -> DataFrame:
    """(g1, g2, arr): one row a range. g1 is the range of hash space and g2 -1, or for a key of ``hot`` (key, cuts) g1 its hash and g2 its time slot."""
    row = F.struct("h", "key", "t", "net", "made")
    if hot is None:
        return events.groupBy(_range_of("h", ranges).alias("g1"), F.lit(-1).cast("long").alias("g2")).agg(F.sort_array(F.collect_list(row)).alias("arr"))
    e = events.join(hot, "key", "left")
    calm = parent_arrays(e.filter("cuts is null").select(*events.columns), ranges, None)
    slots = e.filter("cuts is not null").withColumn("g2", _slot("t", "cuts"))
    sums = slots.groupBy("h", "key", "g2").agg(F.sum("net").alias("net"), F.sum("made").alias("made"))
    every = hot.select("key", F.xxhash64("key").alias("h"), F.explode(F.sequence(F.lit(0).cast("long"), F.size("cuts").cast("long"))).alias("g2"))
    before = Window.partitionBy("key").orderBy("g2").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(sums, ["h", "key", "g2"], "left").select("h", "key", "g2", F.lit(-(2**63)).alias("t"), F.sum("net").over(before).alias("net"), F.sum("made").over(before).alias("made")).filter("net is not null")
    both = slots.select("h", "key", "g2", "t", "net", "made").unionByName(carried)
    return calm.unionByName(both.groupBy(F.col("h").alias("g1"), "g2").agg(F.sort_array(F.collect_list(row)).alias("arr")))


class SortedParents:
    """The events of one range as sorted arrays; ``probe`` looks up a batch by binary search."""

    def __init__(self, events: pa.StructArray) -> None:
        field = {f.name: events.field(i) for i, f in enumerate(events.type)}
        h, t = (field[k].to_numpy(zero_copy_only=False) for k in ("h", "t"))
        self.keys = field["key"]
        first = np.ones(len(h), bool)
        if len(h) > 1:
            first[1:] = (h[1:] != h[:-1]) | ~pc.equal(self.keys[1:], self.keys[:-1]).to_numpy(zero_copy_only=False)
        self.starts = np.flatnonzero(first)
        self.hashes = h[self.starts]
        self.times = np.unique(t)
        self.width = len(self.times) + 1
        self.codes = (np.cumsum(first) - 1) * self.width + np.searchsorted(self.times, t, "right")
        self.net, self.made = (np.concatenate([[0], np.cumsum(field[k].to_numpy(zero_copy_only=False))]) for k in ("net", "made"))

    def probe(self, h: np.ndarray, keys: pa.Array, t: np.ndarray) -> np.ndarray:
        """For each reference the index of its reason in REASONS."""
        at, end = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        at_safe = np.minimum(at, len(self.hashes) - 1)
        same = pc.fill_null(pc.equal(self.keys.take(pa.array(self.starts[at_safe])), keys), False).to_numpy(zero_copy_only=False)
        known = (at < end) & same
        for i in np.flatnonzero((end - at > 1) & ~same):  # keys that share a hash
            for j in range(at[i] + 1, end[i]):
                if self.keys[self.starts[j]].as_py() == keys[i].as_py():
                    at_safe[i], known[i] = j, True
        upto = np.searchsorted(self.codes, at_safe * self.width + np.searchsorted(self.times, t, "right"), "right")
        upto = np.maximum(upto, self.starts[at_safe])
        live, made = (x[upto] - x[self.starts[at_safe]] for x in (self.net, self.made))
        return np.where(~known, 1, np.where(live > 0, 0, np.where(made > 0, 3, 2)))


def _probe(batches: Iterable[pa.RecordBatch], keep_ok: bool) -> Iterator[pa.RecordBatch]:
    here: tuple | None = None
    parents: SortedParents | None = None
    for b in batches:
        col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        ids = np.stack([col[k].to_numpy(zero_copy_only=False) for k in ("g1", "g2", "salt")])
        is_ref = col["kind"].to_numpy(zero_copy_only=False) == 1
        h = pc.fill_null(col["h"], 0).to_numpy(zero_copy_only=False)
        t = pc.fill_null(col["t"], -(2**63)).to_numpy(zero_copy_only=False)
        no_t = pc.is_null(col["t"]).to_numpy(zero_copy_only=False)
        reason = np.zeros(b.num_rows, np.int64)
        cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1 if b.num_rows > 1 else []
        for s, e in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if s == e:
                continue
            if (g := tuple(ids[:, s])) != here:
                here, parents = g, None
            while s < e and not is_ref[s]:
                parents = SortedParents(col["arr"].slice(s, 1).flatten())
                s += 1
            if s < e:
                reason[s:e] = 1 if parents is None else parents.probe(h[s:e], col["key"].slice(s, e - s), t[s:e])
        reason[no_t & (reason != 1)] = 4
        keep = pa.array(is_ref & (keep_ok | (reason != 0)))
        out = pa.RecordBatch.from_arrays([col["row"], pa.array(np.array(REASONS, object)[reason], pa.string())], ["row", "reason"])
        yield out.filter(keep)


def probe_references(
    refs: DataFrame,
    parents: DataFrame,
    *,
    key: Column,
    at: Column,
    parent_key: Column,
    created: Column,
    deleted: Column,
    reason: str = "reason",
    keep_ok: bool = False,
    events_per_range: int = 4_000,
    refs_per_task: int = 250_000,
) -> DataFrame:
    """The rows of ``refs`` whose parent was not alive at ``at``, with the column ``reason``; with ``keep_ok`` all rows."""
    events = written(parent_events(parents, parent_key, created, deleted), "parents")
    sizes = events.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    total, most = sizes["n"] or 0, sizes["most"] or 0
    ranges, hot = max(1, math.ceil(total / events_per_range)), None
    if most > events_per_range:
        slots = math.ceil(most / events_per_range)
        counted = events.groupBy("key").agg(F.count("*").alias("n"), F.percentile_approx("t", [i / slots for i in range(1, slots)], F.lit(max(10_000, slots * 10))).alias("cuts"))
        hot = written(counted.filter(F.col("n") > events_per_range).select("key", F.array_distinct("cuts").alias("cuts")), "hot-parents")
    arrays = parent_arrays(events, ranges, hot)

    r = refs.select(F.struct(*[F.col(f"`{c}`") for c in refs.columns]).alias("row"), key.alias("key"), F.unix_micros(at.cast("timestamp")).alias("t")).withColumn("h", F.when(F.col("key").isNotNull(), F.xxhash64("key")))
    r = r.withColumn("g1", F.coalesce(_range_of("h", ranges), F.lit(-1).cast("long"))).withColumn("g2", F.lit(-1).cast("long"))
    if hot is not None:
        slot = F.when(F.col("t").isNull(), F.lit(0).cast("long")).otherwise(_slot("t", "cuts"))
        r = r.join(hot, "key", "left").withColumn("g1", F.when(F.col("cuts").isNotNull(), F.col("h")).otherwise(F.col("g1"))).withColumn("g2", F.when(F.col("cuts").isNotNull(), slot).otherwise(F.col("g2"))).drop("cuts")
    counts = written(r.groupBy("g1", "g2").agg(F.count("*").alias("n")), "ranges")
    size = counts.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    # Several ranges meet in a task by chance; tasks are planned for a quarter of what one may hold.
    tasks = max(1, math.ceil(4 * (size["n"] or 0) / refs_per_task))
    if (size["most"] or 0) > refs_per_task:
        counts = counts.select("g1", "g2", F.ceil(F.col("n") / refs_per_task).cast("long").alias("copies")).filter("copies > 1")
        r = r.join(counts, ["g1", "g2"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("row"), F.col("copies")), F.lit(0).cast("long"))).drop("copies")
        arrays = arrays.join(counts, ["g1", "g2"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("copies"), F.lit(1)) - 1))).drop("copies")
    else:
        r, arrays = (x.withColumn("salt", F.lit(0).cast("long")) for x in (r, arrays))
    null = lambda kind: F.lit(None).cast(kind)
    order = ["g1", "g2", "salt", "kind", "h", "key", "t", "row", "arr"]
    r = r.withColumn("kind", F.lit(1)).withColumn("arr", null(_EVENT)).select(*order)
    arrays = arrays.select("g1", "g2", "salt", F.lit(0).alias("kind"), null("long").alias("h"), null("string").alias("key"), null("long").alias("t"), null(r.schema["row"].dataType).alias("row"), F.col("arr").cast(_EVENT).alias("arr"))
    routed = arrays.unionByName(r).repartition(tasks, "g1", "g2", "salt").sortWithinPartitions("g1", "g2", "salt", "kind")
    schema = T.StructType([T.StructField("row", r.schema["row"].dataType), T.StructField("reason", T.StringType())])
    found = routed.mapInArrow(lambda batches: _probe(batches, keep_ok), schema)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in refs.columns], F.col("reason").alias(reason))


def iso_time(text: Column) -> Column:
    """An ISO 8601 instant in extended or basic notation as a timestamp; UTC where it names no zone; null where it is none."""
    t = F.trim(text)
    t = F.when(t.rlike(r"([zZ]|[+-]\d\d:?\d\d)$") | ~t.rlike(r"\d[Tt ]\d"), t).otherwise(F.concat(t, F.lit("Z")))
    basic = F.regexp_replace(t, r"^(\d{4})(\d\d)(\d\d)[Tt](\d\d)(\d\d)(\d\d)", "$1-$2-$3T$4:$5:$6")
    return F.regexp_replace(basic, r"([+-]\d\d)(\d\d)$", "$1:$2").try_cast("timestamp")


def named_page(target: Column) -> Column:
    """The page that a wikilink target names: what stands before a label or an anchor, without outer spaces."""
    return F.trim(F.regexp_extract(target, r"^([^|#]*)", 1))


def link_references(link: DataFrame) -> DataFrame:
    """(tbl, src, pos, target, key, at) of a link table, each reference once."""
    return link.select(F.lit("link").alias("tbl"), F.concat_ws("/", "sub", "name").alias("src"), F.col("pos").cast("int").alias("pos"), "target", named_page(F.col("target")).alias("key"), F.col("seen_at").alias("at")).distinct()


def entity_references(envelope: DataFrame) -> DataFrame:
    """(tbl, src, pos, target, key, at) of the entities of an envelope table, one row a chunk and slug."""
    e = envelope.select(F.col("source.sha256").alias("src"), F.col("source.chunk.idx").cast("int").alias("pos"), F.explode(F.array_distinct(F.col("entities.slug"))).alias("target"), iso_time(F.col("extraction.extracted_at")).alias("at"))
    return e.select(F.lit("envelope").alias("tbl"), "src", "pos", "target", F.col("target").alias("key"), "at").distinct()


def wiki_references(link: DataFrame, page: DataFrame, envelope: DataFrame, entity_page: DataFrame, **how: object) -> DataFrame:
    """The orphans (with ``keep_ok`` all) of both kinds of reference: tbl, src, pos, target, at, reason."""
    alive = {"key": F.col("key"), "at": F.col("at"), "created": F.col("created_at"), "deleted": F.col("deleted_at")} | how
    out = probe_references(written(link_references(link), "links"), page, parent_key=F.col("stem"), **alive)
    return out.unionByName(probe_references(written(entity_references(envelope), "mentions"), entity_page, parent_key=F.col("slug"), **alive)).drop("key")


def orphan_report(probed: DataFrame) -> DataFrame:
    """Of all probed references: by table and month their number and how many of them are orphans, by reason."""
    n = lambda r: F.count_if(F.col("reason") == r).alias(r)
    return probed.groupBy("tbl", F.date_format("at", "yyyy-MM").alias("month")).agg(F.count("*").alias("refs"), F.count_if(F.col("reason") != "ok").alias("orphans"), *map(n, REASONS[1:]))
