"""Jobs, sources and sinks from end to end on small folders."""

import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from notewright import session
from notewright.operators import extract, extraction, pacing, registry, render
from notewright.sources import files as S
from notewright.sources import sinks as K
from notewright.streaming import jobs as J


def test_places_in_order_and_scratch_tables(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("aab"), rnd.randint(0, 50), i) for i in range(500)]
    before = len(session._WRITTEN)
    with session.scratch(spark):
        got = session.in_order(spark.createDataFrame(rows, "g string, v int, i int").repartition(7), ["g", "v", "i"]).collect()
        assert len(session._WRITTEN) == before + 1
    assert len(session._WRITTEN) == before
    assert [(r["g"], r["v"], r["i"]) for r in sorted(got, key=lambda r: r["place"])] == sorted(rows) and sorted(r["place"] for r in got) == list(range(1, 501))
    assert session.in_order(spark.createDataFrame([], "g string"), ["g"]).count() == 0


def test_paces_against_a_loop(spark):
    rnd = random.Random(2)
    calls = [(rnd.choice(["x", "x", "y", None]), i, rnd.random() < 0.85, rnd.choice([None, rnd.randint(1, 9_000)])) for i in range(3_000)]
    df = spark.createDataFrame(calls, "k string, ord int, ok boolean, ms int").repartition(5)
    want, smooth = {}, {}
    for k, _, ok, ms in calls:
        i, s, n = want.get(k, (4_000, 0, 0))
        i, s = (min(300_000, max(1_500, i * 2)), 0) if not ok else (max(1_500, i - 250), 0) if s + 1 >= 10 else (i, s + 1)
        want[k] = (i, s, n + 1)
        if ms is not None:
            smooth[k] = ms if k not in smooth else int(smooth[k] * 0.7 + ms * 0.3)
    assert {r["k"]: (r["interval_ms"], r["ok_streak"], r["calls"]) for r in pacing.paced(df, "k", ["ord"], F.col("ok")).collect()} == want
    assert {r["k"]: r["latency_ms"] for r in pacing.smoothed_latency(df, "k", ["ord"], F.col("ms")).collect()} == smooth
    assert pacing.paced(df.limit(0), "k", ["ord"], F.col("ok")).count() == 0


def test_a_model_is_closed_as_long_as_its_refusal_says(spark):
    rows = [("m", 1_750_000_000, "quota", True, 600.0), ("n", 1_750_000_000, "quota", True, 9e9), ("o", 1_750_000_000, "quota", True, None), ("p", 1_750_000_000, "quota", False, 1.0)]
    df = spark.createDataFrame(rows, "model string, t bigint, status string, long boolean, reset double")
    got = {r["model"]: r["exhausted_until"] for r in pacing.model_days(df, "model", F.col("t"), F.col("status"), F.col("long"), F.col("reset")).collect()}
    assert got["m"] == 1_750_000_600 and got["n"] == got["o"] > got["m"] and got["p"] is None


def test_sinks(spark, tmp_path):
    t = str(tmp_path)
    assert K.current_table(spark, f"{t}/x") is None
    K.replace_table(spark.createDataFrame([(1,)], "a int"), f"{t}/x")
    K.replace_table(spark.createDataFrame([(2,), (3,)], "a int"), f"{t}/x")
    assert sorted(r["a"] for r in K.current_table(spark, f"{t}/x").collect()) == [2, 3]
    staged = spark.createDataFrame([("wiki/entities/é.md", "texte é"), ("wiki/sources/index.md", "x")], "rel string, content string")
    rows = spark.createDataFrame([("p", "", 1.239)], "path string, reason string, duration_s double")
    assert K.promote(staged, t, rows, f"{t}/ledger", phase="merge", now="2025-01-01T00:00:00Z") == 2
    assert (tmp_path / "wiki/entities/é.md").read_text() == "texte é" and not [f for f in os.listdir(tmp_path / "wiki/entities") if f != "é.md"]
    K.append_ledger(rows, f"{t}/ledger", phase=None, now="2025-01-02T00:00:00Z", schema=2)
    lines = {r["schema"]: r for r in spark.read.json(f"{t}/ledger").collect()}
    assert lines[3]["phase"] == "merge" and lines[3]["produced"] == [] and lines[3]["duration_s"] == 1.24 and "reason" not in lines[3] and lines[2]["phase"] is None
    with pytest.raises(ValueError, match=r"index\.md"):
        K.write_pages(spark.createDataFrame([("wiki/ok.md", "x"), ("/index.md", "x")], "rel string, content string"), f"{t}/none")
    assert not os.path.exists(f"{t}/none")
    assert K.milestones(spark, f"{t}/m").count() == 0
    for v in (5, 7):
        K.set_milestone(spark, f"{t}/m", "heartbeat", v)
    assert [tuple(r) for r in K.milestones(spark, f"{t}/m").collect()] == [("heartbeat", 7)]
    p = K.load_pace(spark, f"{t}/pace").first()
    assert p["interval_ms"] == 4_000 and p["ok_streak"] == 0 and p["models"] == {}
    assert K.save_pace(K.load_pace(spark, f"{t}/pace").withColumn("interval_ms", F.lit(9)), f"{t}/pace", now=5)
    (tmp_path / "pace" / "bad.json").write_text("{nonsense\n")
    assert K.load_pace(spark, f"{t}/pace").first()["interval_ms"] == 1_500 and not K.save_pace(K.load_pace(spark, f"{t}/pace"), "nofs://x/y", now=5)
    stamp = spark.sql("SELECT timestamp '2025-01-02 03:04:05Z' AS t").select(K.stamp(F.col("t"))).first()[0]
    assert stamp == "2025-01-02T03:04:05Z"


def test_reports(spark, tmp_path):
    f = spark.createDataFrame([("CRITIQUE", "R1", "a|b", "x\ny", 1, 1), ("INFO", "R6", "c", None, 4, 1), ("INFO", "R7", "d", "z", 4, 2)], "severity string, rule string, location string, observed string, section int, place int")
    pages, state = spark.range(3), spark.createDataFrame([("ok",), ("ok",), (None,)], "status string")
    lines = [r["line"] for r in render.report_lines(f, pages, state).orderBy("section", "place", "line").collect()]
    assert lines[:3] == ["pages: 3", "CRITIQUE: 1", "INFO: 2"] and "ledger ok: 2" in lines and "ledger none: 1" in lines
    assert "| R1 | a\\|b | x y |" in lines and lines.index("| R6 | c |  |") < lines.index("| R7 | d | z |") and lines[-3].startswith("## INFO")
    render.json_report(f, pages, "2025-01-01", str(tmp_path))
    assert spark.read.json(f"{tmp_path}/findings").count() == 3 and spark.read.json(f"{tmp_path}/summary").first()["pages"] == 3
    index = spark.createDataFrame([("entities", 1, "a.md", "m.md", 250), ("entities", 2, "n.md", "z.md", 9)], "sub string, page_no long, first string, last string, n long")
    assert [r["line"] for r in render.index_summary(index).orderBy("page_no").collect()] == ["- [[index-entities-001]] : a … m (250)", "- [[index-entities-002]] : n … z (9)"]


def test_more_file_sources(spark, tmp_path):
    t = str(tmp_path)
    assert S.registry_file(spark, f"{t}/none.json").count() == 0
    (tmp_path / "bad.json").write_text("{oops")
    (tmp_path / "reg.json").write_text(json.dumps({"k": {"name": "K", "aliases": ["a"], "docs": ["d"], "definitions": [{"doc": "d", "text": "t", "salience": "primary"}]}, "l": {"name": "L"}}))
    assert S.registry_file(spark, f"{t}/bad.json").count() == 0
    assert {r["key"]: (r["name"], r["docs"]) for r in S.registry_file(spark, f"{t}/reg.json").collect()} == {"k": ("K", ["d"]), "l": ("L", None)}
    raw = tmp_path / "raw"
    (raw / "Projet").mkdir(parents=True)
    for n, size in (("b.md", 5), ("a.txt", 9), ("Projet/z.md", 99), ("c.docx", 1), ("d.MD", 1), ("e.md", 5)):
        (raw / n).write_text("x" * size)
    listing = S.file_listing(spark, str(raw))
    assert [os.path.basename(r["path"]) for r in S.processing_order(listing, first="/Projet/", most=3).collect()] == ["z.md", "c.docx", "d.MD"]
    settled = listing.filter("path like '%e.md'")
    assert sorted(os.path.basename(r["path"]) for r in S.eligible_notes(spark, str(raw), settled).collect()) == ["a.txt", "b.md", "c.docx", "z.md"] and S.eligible_notes(spark, str(raw), settled, most=2).count() == 2
    (tmp_path / "list").write_text("# c\n\nx\n" + listing.filter("path like '%b.md'").first()["path"] + "\n")
    assert S.listed_files(spark, f"{t}/list").count() == 2 and S.listed_files(spark, f"{t}/list", listing).count() == 1
    assert render.fingerprint(render.file_lines(listing)).first() == render.fingerprint(render.file_lines(listing.repartition(3))).first()


def test_spool_is_purged_drained_and_sent(spark, tmp_path):
    for i in range(12):
        p = tmp_path / f"m{i:02d}.json"
        p.write_text({8: "{bad", 9: json.dumps({"text": "  "}), 10: json.dumps({"text": "x" * 70_000})}.get(i, json.dumps({"emoji": "OK", "text": f"message {i}"})))
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    (tmp_path / "note.txt").write_text("x")
    f = S.spool_files(spark, str(tmp_path), keep=9, take=8).persist()
    m = S.spool_messages(f)
    assert [r["text"] for r in m.collect()] == [f"message {i}" for i in (3, 4, 5, 6, 7)]
    sent, removed = [], []
    assert K.send_spool(f, m, lambda x: sent.append(x["text"]) or x["text"] != "message 4", removed.append) == 4
    assert sent[0] == "message 3" and sorted(os.path.basename(x) for x in removed) == [f"m{i:02d}.json" for i in (0, 1, 2, 3, 5, 6, 7, 8, 9, 10)]
    f.unpersist()
    got = []
    J.run_available(J.watched_messages(spark, str(tmp_path), files=5), f"spool-{uuid.uuid4().hex}", sink=lambda df, n: got.extend(J.drained(df).collect()))
    assert sorted(r["message"] for r in got) == sorted(f"✅ message {i}" for i in (0, 1, 2, 3, 4, 5, 6, 7, 11))


def test_registry_is_kept_across_batches(spark, tmp_path):
    schema = "slug string, name string, kind string, subtype string, aliases array<string>, tags array<string>, docs array<string>, max_salience string, first_seen string, last_seen string"
    rows = [[("x", "X", "entity", None, ["a"], [], ["d1"], "passing", "2025-01-02", "2025-01-02")], [("x", "Y", "entity", None, ["b"], ["t"], ["d2"], "primary", "2025-01-01", "2025-01-03"), ("z", "Z", "concept", None, [], [], ["d2"], "passing", "2025-01-03", "2025-01-03")]]
    sink = J.upserted(f"{tmp_path}/registry", registry.merge_registry, lambda df: df)
    for n, batch in enumerate(rows):
        sink(spark.createDataFrame(batch, schema), n)
        sink(spark.createDataFrame(batch, schema), n)  # done again
    got = {r["slug"]: r for r in K.current_table(spark, f"{tmp_path}/registry").collect()}
    assert (got["x"]["name"], got["x"]["aliases"], got["x"]["docs"], got["x"]["max_salience"], got["x"]["first_seen"], got["x"]["last_seen"]) == ("X", ["a", "b"], ["d1", "d2"], "primary", "2025-01-01", "2025-01-03") and len(got) == 2


NOTE = "# Titre du document\n\nLe service de Marseille et de Lyon. On parle de Marseille encore, puis de Lyon.\n\n" + "Une phrase ordinaire du texte. " * 40


def test_extraction_from_notes_to_ledger(spark):
    notes = spark.createDataFrame([("/n/a.md", "s1", 10, 5, NOTE), ("/n/b.md", "s2", 10, 5, NOTE * 40), ("/n/c.md", "s3", 10, 5, "court"), ("/n/d.md", "s4", 0, 5, ""), ("/n/e.md", "s5", 0, 5, None)], "path string, sha256 string, size bigint, changed_ns bigint, text string")
    spans = extract.spans_of(notes, F.lit(9_000))
    n = {r["path"]: r["n"] for r in spans.groupBy("path").agg(F.count("*").alias("n")).collect()}
    assert n["/n/a.md"] == 1 and n["/n/b.md"] > 1 and set(n) == {"/n/a.md", "/n/b.md", "/n/c.md"}
    done = spark.createDataFrame([("s1", 0, 1), ("s2", 0, 99)], "sha256 string, idx int, total int")
    left = extract.to_do(spans, done)
    assert left.filter("path = '/n/a.md'").count() == 0 and left.filter("path = '/n/b.md'").count() == n["/n/b.md"] and extract.to_do(spans, done, most_calls=1).count() == 1
    got = extract.answers(spans, "hors-ligne", "Extrais.").persist()
    e = extract.envelopes(got, F.lit("2025-01-01T00:00:00Z"))
    first = e.filter("source.sha256 = 's1'").first()
    assert first["note"]["title"] == "Titre du document" and {x["slug"] for x in first["entities"]} >= {"marseille", "lyon"}
    rows = {r["path"]: r for r in extract.ledger_rows(got, extraction.validate(e)).collect()}
    assert rows["/n/a.md"]["status"] == "extracted" and rows["/n/b.md"]["status"] == "extracted" and rows["/n/b.md"]["chunks"]["done"] == n["/n/b.md"]
    assert (rows["/n/c.md"]["status"], rows["/n/c.md"]["reason"]) == ("failed", "extract_invalid")

    def broken(request):
        if "court" in request["contents"]["parts"][0]["text"]:
            raise OSError("down")
        return {"status": "ok", "text": "[1]"}

    bad = extract.answers(spans, "m", "x", extractor=broken)
    assert extract.envelopes(bad, F.lit("t")).count() == 0
    reasons = {r["path"]: r["reason"] for r in extract.ledger_rows(bad, extraction.validate(extract.envelopes(bad, F.lit("t")))).collect()}
    assert reasons == {"/n/a.md": "extract_invalid", "/n/b.md": "extract_invalid", "/n/c.md": "http_error"}
    got.unpersist()


def test_requests(spark):
    df = spark.createDataFrame([("doc", "fam-3-x")], "c string, model string")
    mark = extract.nonce(F.lit("sha"), F.lit(12))
    p = df.select(extract.prompt(F.col("c"), mark, F.lit("a.md"), "Fais.").alias("p"), extract.payload(F.col("c")).alias("j"), extract.payload(F.col("c"), schema="s", temperature=0.5).alias("k")).first()
    assert p["p"].startswith("Fais.\n\n<document ") and p["p"].endswith("a.md") and json.loads(p["j"])["config"] == {} and json.loads(p["k"])["config"] == {"response_schema": "s", "temperature": 0.5}
    row = df.select(extract.thinking_config(F.col("model"), {"fam": "low", "fam-3": "high"}), extract.thinking_config(F.lit("other"), {"fam": "low"}), extract.thinking_rejected(F.lit(400), F.lit("bad Thinking Level")), extract.thinking_rejected(F.lit(400), F.lit(None).cast("string"))).first()
    assert tuple(row) == ("high", None, True, False)


def test_models_and_budgets(spark):
    states = spark.createDataFrame([("a", 100), ("b", None), ("c", 10)], "model string, exhausted_until long")
    assert {r["model"] for r in pacing.open_models(states, F.lit(50)).collect()} == {"b", "c"}
    days = spark.createDataFrame([("a", "d", 2), ("b", "d", 3), ("a", "e", 9)], "model string, day string, ok long")
    assert pacing.calls_of_day(days, F.lit("d")).first()["counts"] == {"a": 2, "b": 3}
    tries = [("r", 1, "a", "quota", "daily"), ("r", 2, "b", "ok", None), ("s", 1, "a", "quota", "minute"), ("s", 2, "b", "ok", None), ("t", 1, "a", "quota", "daily"), ("t", 2, "b", "quota", "daily")]
    got = {r["request"]: (r["model"], r["status"]) for r in pacing.cascaded(spark.createDataFrame(tries, "request string, prio int, model string, status string, scope string")).collect()}
    assert got == {"r": ("b", "ok"), "s": ("a", "quota"), "t": ("b", "quota")}
    big = spark.createDataFrame([(40_000,), (20_000,), (30_000,)], "t long")
    assert big.agg(pacing.learned_threshold(F.lit(50_000), F.col("t"))).first()[0] == 16_000 and big.limit(0).agg(pacing.learned_threshold(F.lit(50_000), F.col("t"))).first()[0] is None
    due = spark.createDataFrame([("ingest-due-at", 90), ("other", 999)], "name string, value long")
    assert [pacing.weekly_run(due, F.lit(n)).first()["start"] for n in (80, 90)] == [False, True] and pacing.weekly_run(due.limit(0), F.lit(1)).first()["start"]
    assert [r["t"] for r in pacing.within_budget(big, ["t"], 2).collect()] == [20_000, 30_000] and pacing.within_budget(big, ["t"], -1).count() == 0


def test_strict_front_matter(spark):
    from notewright.functions import text as X

    df = spark.createDataFrame([("---\nb: 1\na: 2 ---\nb: 3\n---\nx",), ("---\nk = v\n---\nx",), ("a\n\nb\n",)], "t string")
    got = [(r["f"]["fm"] and [(k, r["f"]["fm"][k]) for k in r["k"]], r["f"]["err"], r["l"]) for r in df.select(X.front_matter(F.col("t"), strict=True).alias("f"), F.map_keys(X.front_matter(F.col("t"), strict=True).fm).alias("k"), X.lines_of(F.col("t")).alias("l")).collect()]
    assert got[0][:2] == ([("b", "3"), ("a", "2 ---")], None) and got[1][:2] == (None, "line") and got[2][1:] == ("absent", ["a", "b"])
