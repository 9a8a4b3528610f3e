"""Problem 1: orphan references against brute force, with hot keys, hot references, nulls and clashing names."""

import datetime as dt
import random

from pyspark.sql import functions as F

from notewright.operators import references as R

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
PARENT = "k string, c timestamp, d timestamp"
REF = "id int, key string, reason string, h string, at timestamp"


def day(n):
    return None if n is None else T0 + dt.timedelta(days=n)


def brute(refs, parents):
    out = {}
    for i, key, *_, at in refs:
        mine = [(c, d) for k, c, d in parents if k is not None and k == key and c is not None and (d is None or d > c)]
        if any(at is not None and c <= at and (d is None or at < d) for c, d in mine):
            out[i] = "ok"
        elif not mine:
            out[i] = "missing"
        else:
            out[i] = "no_time" if at is None else "deleted" if any(c <= at for c, _ in mine) else "not_yet"
    return out


def probe(spark, refs, parents, **how):
    r, p = spark.createDataFrame(refs, REF), spark.createDataFrame(parents, PARENT)
    return R.probe_references(r, p, key=F.col("key"), at=F.col("at"), parent_key=F.col("k"), created=F.col("c"), deleted=F.col("d"), reason="why", keep_ok=True, **how)


def case(seed, hot):
    rnd = random.Random(seed)
    keys = [None, "", "é", "E", "a b", *(f"k{i}" for i in range(25))]
    pick = lambda: "hot" if rnd.random() < hot else rnd.choice(keys)
    parents = [(pick(), day(rnd.choice([None, *range(60)])), day(rnd.choice([None, None, *range(60)]))) for _ in range(300)]
    refs = [(i, pick(), "x", "y", day(rnd.choice([None, *range(70)]))) for i in range(700)]
    return refs, parents


def test_against_brute_force_with_ranges_slots_and_copies(spark):
    for seed, hot in ((1, 0.0), (2, 0.4)):
        refs, parents = case(seed, hot)
        for how in ({}, {"events_per_range": 15, "refs_per_task": 40}):
            got = {r["id"]: r["why"] for r in probe(spark, refs, parents, **how).collect()}
            assert got == brute(refs, parents)


def test_clashing_columns_pass_through_and_repeats_keep_their_rows(spark):
    refs = [(1, "a", "mine", "h", day(3)), (1, "a", "mine", "h", day(3))]
    rows = probe(spark, refs, []).collect()
    assert [(r["reason"], r["h"], r["why"]) for r in rows] == [("mine", "h", "missing")] * 2


def test_empty_tables(spark):
    assert probe(spark, [], [("a", day(1), None)]).count() == 0


def test_keys_that_share_a_hash(spark):
    import numpy as np
    import pyarrow as pa

    events = pa.array([{"h": 7, "key": "a", "t": 1, "net": 1, "made": 1}, {"h": 7, "key": "b", "t": 5, "net": 1, "made": 1}])
    found = R.SortedParents(events).probe(np.array([7, 7, 7, 8]), pa.array(["b", "a", "c", "a"]), np.array([2, 2, 9, 9]))
    assert [R.REASONS[i] for i in found] == ["not_yet", "ok", "missing", "missing"]


def test_iso_notations_and_named_pages(spark):
    rows = [("2024-02-04T07:08:45Z",), ("2024-02-04T08:08:45+01:00",), ("2024-02-04T07:08:45.000Z",), ("20240204T070845Z",), ("2024-02-04 07:08:45",), ("soon",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(F.unix_timestamp(R.iso_time(F.col("x")))).collect()]
    assert got == [1707030525] * 5 + [None, None]
    names = [(" Page A |label",), ("B#anchor",), ("C",), (None,)]
    assert [r[0] for r in spark.createDataFrame(names, "x string").select(R.named_page(F.col("x"))).collect()] == ["Page A", "B", "C", None]
