"""Languages, truncation, splitting and quality: small fixtures with nulls, empty and very long texts, ties, repeats and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from notewright.llm import language as L
from notewright.llm import quality as Q
from notewright.llm import splitting as S
from notewright.llm import truncation as T
from notewright.sources import read_table

SF = "/root/testdata/sf0.001"
FR = "La réunion de mardi a confirmé que le seuil était trop bas pour les équipes. "
EN = "The meeting of the board has confirmed that the limit was too low for all of them. "


@pytest.fixture(scope="module")
def profiles(spark):
    e = read_table(spark, "/root/testdata/sf0.01", "envelope")
    return L.train_profiles(L.envelope_texts(e), F.col("text"), read_table(spark, SF, "common_word"))


def test_labels(spark):
    rows = [("fr",), ("FR-ca",), ("Français",), ("eng",), ("pt_BR",), ("und",), ("",), (None,), ("mul",), ("frx",)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(L.label_language(F.col("x"))).collect()]
    assert got == ["fr", "fr", "fr", "en", "pt", None, None, None, None, None]


def test_segments(profiles):
    text = FR + EN + FR
    got = profiles.segments(text)
    assert [s[2] for s in got] == ["fr", "en", "fr"] and got[0][0] == 0 and all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))
    assert [s[2] for s in profiles.segments("Le message « Request quota exceeded and not the other one » apparaît dans le journal de William Smith.")] == ["fr"]
    assert profiles.segments("") == [] and profiles.segments("123 456. 7") == []
    assert {s[2] for s in profiles.segments(FR * 3000)} == {"fr"}


def test_held_out_sentences_get_their_language(profiles):
    held = {
        "fr": "Nous avons demandé que la liste soit publiée avant la fin du mois.", "en": "We asked that the list should be published before the end of the month.",
        "de": "Wir haben darum gebeten, dass die Liste vor dem Ende des Monats veröffentlicht wird.", "es": "Hemos pedido que la lista se publique antes del final del mes.",
        "it": "Abbiamo chiesto che la lista sia pubblicata prima della fine del mese.", "pt": "Pedimos que a lista seja publicada antes do fim do mês.",
    }
    assert {k: profiles.judge(v)[0] for k, v in held.items()} == {k: k for k in held}


def test_language_segments_keep_clashing_columns(spark, profiles):
    df = spark.createDataFrame([(1, FR, "x"), (2, None, "y"), (2, None, "y"), (3, "", None)], "segments int, text string, row string")
    got = L.language_segments(df, F.col("text"), profiles, into="found").withColumn("main", L.main_language(F.col("found"))).collect()
    assert [(r["segments"], r["row"], len(r["found"]), r["main"] and r["main"]["lang"]) for r in sorted(got, key=lambda r: r["segments"])] == [(1, "x", 1, "fr"), (2, "y", 0, None), (2, "y", 0, None), (3, None, 0, None)]
    assert L.language_segments(df.limit(0), F.col("text"), profiles).count() == 0


def test_untrained_profiles_still_know_common_words(spark):
    p = L.train_profiles(spark.createDataFrame([], "text string"), F.col("text"), read_table(spark, SF, "common_word"))
    assert set(p.ranks) == set(L.LANGUAGES) and all(p.ranks.values())


def test_distances_are_the_sums_of_rank_differences(profiles):
    words = L.content_words(FR + EN + "Ça zzqj 12 coûte")
    ranked = [g for g, _ in sorted(L.grams(words).items(), key=lambda x: (-x[1], x[0]))]
    far = L.PROFILE_SIZE
    want = {x: sum(min(abs(r[g] - i), far) if g in r else far for i, g in enumerate(ranked)) / (far * len(ranked)) for x, r in profiles.ranks.items()}
    assert profiles.distances(words) == pytest.approx(want) and profiles.distances([]) == {}


@pytest.mark.parametrize("buckets", [1, 5])
def test_most_frequent_in_two_steps(spark, buckets):
    rnd = random.Random(9)
    rows = {(g, f"i{i}"): rnd.randint(1, 9) for g in "ab" for i in range(80)}
    got = L.most_frequent(spark.createDataFrame([(*k, n) for k, n in rows.items()], "g string, item string, n int"), ["g"], F.when(F.col("g") == "a", 12).otherwise(30), buckets=buckets).collect()
    want = {g: [i for (x, i), _ in sorted(rows.items(), key=lambda e: (-e[1], e[0][1])) if x == g][: {"a": 12, "b": 30}[g]] for g in "ab"}
    assert {g: [r["item"] for r in sorted(got, key=lambda r: r["r"]) if r["g"] == g] for g in "ab"} == want


def test_fragments_take_the_nearest_sentence(profiles):
    assert [s[2] for s in profiles.segments(FR + "12. 3. " + EN + "4. 5.")] == ["fr", "en"]
    assert [s[2] for s in profiles.segments("\n".join([FR, "7."] * 2000))] == ["fr"]


def test_ending_marks():
    cut = ["fin du tr…", "la suite [...]", "rejetés (…)", "Voir [[Déco", "Voir « les entités", 'dit "le cache', "Voir Déco&eacut", "plafond de requ�", "avec (une", "le **gras", "un, deux,"]
    assert all(T.ending_mark(t) for t in cut)
    assert not any(T.ending_mark(t) for t in ["Une phrase.", "sans point final", "cuivre, zinc, etc.", "Version (v2)", "Voir [[Page]].", "le « mot »", "Note [relu]"])


def truncation(spark, rows, corpus):
    values = spark.createDataFrame(rows, "sha256 string, chunk_idx int, area string, field string, value string")
    texts = spark.createDataFrame([(f, t, f == "title") for f, t in corpus], "field string, text string, whole_text boolean")
    return {r["sha256"]: r["cut"] for r in T.truncation_evidence(values, texts).collect()}


def test_truncation_by_endings_and_spikes(spark):
    whole = ["Le planificateur archive le cache de préfixe avant la livraison.", "La passerelle publie le cache de préfixe.", "Le rapport archive les notes de la réunion avant la livraison."] * 8
    rows = [("a", 0, "A", "summary", "Le planificateur archive le cache de pré"), ("b", 0, "A", "summary", "La passerelle publie le cache de préfixe"), ("c", 0, "A", "summary", "Le rapport archive les notes de la"), ("d", 0, None, "summary", whole[0]), ("e", 0, None, "title", "")]
    corpus = [("summary", t) for t in whole] + [("summary", r[4]) for r in rows]
    got = truncation(spark, rows, corpus)
    assert got["a"] == "word" and got["c"] == "phrase" and got["b"] is None and got["d"] is None
    rnd = random.Random(1)
    spiked = [(f"s{i}", 0, "Z", "summary", "".join(rnd.choice("abcdefg ") for _ in range(99)) + "x") for i in range(12)]
    assert set(truncation(spark, spiked, [("summary", "rien.")]).values()) == {"limit"}
    assert truncation(spark, rows[:1], []) == {"a": None}


def test_truncation_of_an_empty_table(spark):
    e = read_table(spark, SF, "envelope").limit(0)
    assert T.truncation_evidence(T.envelope_values(e), T.envelope_corpus(e)).count() == 0


def test_corpus_counts_are_those_of_all_contexts(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["le", "la", "chat", "Été.", "maison", "maisonnette", "dort,", "12"]) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    rows = [(str(i), 0, "A", "summary", t) for i, t in enumerate(texts) if t] + [("t", 0, "A", "title", "le chat"), ("u", 0, "A", "summary", "la mai")]
    values = spark.createDataFrame(rows, "sha256 string, chunk_idx int, area string, field string, value string")
    v = values.mapInArrow(T._evidence, "sha256 string, chunk_idx int, area string, field string, value string, mark string, terminal boolean, ctx array<bigint>, word array<bigint>, first array<bigint>")
    corpus = spark.createDataFrame([("summary", t, False) for t in texts] + [("title", "le chat", True)], "field string, text string, whole_text boolean")
    got = {r["h"]: (r["n"], r["ends"]) for r in T.corpus_counts(v, corpus).collect() if r["n"]}
    asked = {h for r in v.collect() for h in r["ctx"]}
    want: dict[int, list[int]] = {}
    for field, text, whole in [("summary", t, False) for t in texts] + [("title", "le chat", True)]:
        runs = list(T.sentences(T.fold_text(text)))
        for i, (run, ends) in enumerate(runs):
            words = ["^", *run]
            for j in range(1, len(words)):
                last = j == len(run)
                if last and not ends and not whole and i == len(runs) - 1:
                    break
                for k in range(1, min(T.MAX_CONTEXT, j + 1) + 1):
                    x = want.setdefault(T._hash(field, words[j - k + 1 : j + 1]), [0, 0])
                    x[0] += 1
                    x[1] += last
    assert {h: tuple(x) for h, x in want.items() if h in asked} == {h: x for h, x in got.items() if h in asked}
    assert T.bloom_words(0) == 1 and T.bloom_words(10**12) == T.BLOOM_MOST and T.bloom_words(1000) == 256


def test_a_word_cut_after_many_signs_is_half(spark):
    long = "anticonstitutionnellement" * 3
    assert truncation(spark, [("a", 0, "A", "summary", f"Le mot {long[:60]}")], [("summary", f"Le mot {long} finit.")] * 4) == {"a": "word"}


@pytest.mark.parametrize("text", ["", "court", "phrase une. " * 400, "x" * 5000, "mot " * 900, ("# Titre\n" + "Une phrase ici. " * 30 + "\n\n") * 9, "é" * 2000, "a\r\n" * 2000, "long texte " * 300])
def test_pieces_cover_the_text_within_the_limit(text):
    got = S.split_text(text, 1800, 120)
    if len(text) <= 1800:
        assert got == [(0, len(text), True)]
        return
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for a, b in zip(got, got[1:], strict=False):
        assert b[0] == a[1] - 120 and b[1] > a[1]
    assert all(0 < e - s <= 1800 for s, e, _ in got)
    assert not any(text[e : e + 1] == "́" for _, e, _ in got)


def test_long_texts_take_time_in_proportion():
    import time

    for text in ("mot. " * 60_000, "a b\n" * 60_000, " " * 300_000, "x" * 300_000):
        began = time.perf_counter()
        assert S.split_text(text, 1800, 120)[-1][1] == len(text)
        assert time.perf_counter() - began < 10


def test_depths_against_walks_to_the_peaks():
    rnd = random.Random(2)
    text = " ".join(rnd.choice(["le chat dort.", "il pleut ici.", "on va au bois.", "oui."]) for _ in range(120))
    places = [p for p, _ in S.gaps(text)]
    like, want = S.likeness(text, places), []
    for i, s in enumerate(like):
        deep = 0.0
        for step in (-1, 1):
            peak, j = s, i + step
            while 0 <= j < len(like) and like[j] >= peak:
                peak, j = like[j], j + step
            deep += peak - s
        want.append(deep)
    assert S.depths(text, places) == pytest.approx(want)


def test_pieces_end_at_a_change_of_topic():
    one, two = "Le chat dort dans la maison du voisin. " * 30, "Les serveurs calculent des modèles chaque nuit. " * 30
    assert S.split_text(one + two, 1800, 100)[0][1] == len(one)


def test_split_oversized(spark):
    df = spark.createDataFrame([("k", 1, "mot. " * 500), ("k", 1, "mot. " * 500), ("n", 2, None), ("s", 3, "court")], "piece_no string, n int, body string")
    got = S.split_oversized(df.withColumnRenamed("piece_no", "id"), ["id", "n"], "body", 1800, 120).collect()
    assert [(r["id"], r["piece_no"]) for r in got] == [("k", 0), ("k", 1)] and got[0]["text"][-120:] == got[1]["text"][:120]
    with pytest.raises(ValueError, match="overlap"):
        S.split_text("x" * 100, 50, 25)


DOCS = [
    ("prose", FR * 3), ("prose", EN * 3), ("prose", (FR * 4).upper()), ("prose", "Anne : " + FR + "\nPaul : " + EN), ("list", "- le cache\n- la note de mardi\n- les droits\n- le journal du mois"), ("list", "1. un cache\n2. deux notes\n3. trois droits pour tous"),
    ("table", "| a | b | c |\n|---|---|---|\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |"), ("table", "nom;valeur;date\nA;1;2\nB;2;3\nC;3;4\nD;5;6\nE;6;7"), ("table", "nom\tb\tc\n" + "valeur\t2\t3\n" * 5),
    ("junk", "4fQx9+ab/" * 30), ("junk", "test\n" * 40), ("junk", "{\"k0\":{\"v\":316915,\"s\":\"koJ2Ut\"},\"k1\":{\"v\":305626,\"s\":\"3VBa9h\"}}"), ("junk", "verrou budget double fiches schéma cache titres " * 6), (None, "court"), (None, None),
]


def test_kinds(spark):
    base = read_table(spark, SF, "documents").select(F.lit(None).cast("int").alias("i"), "text")
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(DOCS)], "i int, text string")
    got = Q.text_quality(base.unionByName(rows), F.col("text"), read_table(spark, SF, "common_word"), ["i"]).filter("i is not null").collect()
    assert {r["i"]: r["kind"] for r in got} == {i: k for i, (k, _) in enumerate(DOCS)}
    null = next(r for r in got if r["i"] == len(DOCS) - 1)
    assert null["words"] is None and null["far_words"] is None


def test_filler_and_garbled_rows_are_junk_and_names_a_list(spark):
    rnd = random.Random(12)
    garbled = "".join(c if c == " " or rnd.random() < 0.6 else rnd.choice("|;~^$*!:0123") for c in FR * 8)
    texts = ["\n".join(f"{rnd.choice('abc')}{i} qsdf jklm azer wxcv" for i in range(12)), garbled, "\n".join(f"- {rnd.choice('ABC')}ob{i}ert Garou{i}dubrous" for i in range(9)), "nom;valeur;date\n" + "\n".join(f"a{i};b;{i}" for i in range(12))]
    base = read_table(spark, SF, "documents").select(F.lit(None).cast("int").alias("i"), "text")
    got = Q.text_quality(base.unionByName(spark.createDataFrame(list(enumerate(texts)), "i int, text string")), F.col("text"), read_table(spark, SF, "common_word"), ["i"]).filter("i is not null").collect()
    assert {r["i"]: r["kind"] for r in got}[0] == "junk" and {r["i"]: r["kind"] for r in got}[1] == "junk" and {r["i"]: r["kind"] for r in got}[3] == "table"
    ragged = Q.structure("a;b;c;d\ne;f;g\nh;i;j")
    assert (ragged[2], ragged[5]) == (10, 7)


def test_structural_profiles_come_from_the_documents(spark):
    words = read_table(spark, SF, "common_word")
    vocabulary = Q.Vocabulary((r.lang, r.word) for r in words.collect())
    counts = Q.text_counts(spark.createDataFrame([(FR * 9 + "\n\n- un mot\n- deux mots",)] * 30, "text string"), F.col("text"), vocabulary, [])
    got = Q.structural_profiles(counts, Q.prose_profiles(counts, vocabulary))
    assert got[0][0] < 0.99 and got[0][1] > 0.015 and got.sum(axis=1) == pytest.approx([1] * 4) and got[2] == pytest.approx(Q.STRUCTURES["table"])


def test_figures_and_edge_cases(spark):
    df = spark.createDataFrame([(1, "Le chat dort.\nFin"), (1, "Le chat dort.\nFin"), (2, ""), (3, "x" * 200_000)], "kind int, text string")
    got = Q.text_quality(df, F.col("text"), read_table(spark, SF, "common_word"), ["kind"])
    assert got.columns.count("kind") == 2
    rows = got.toDF("id", *got.columns[1:]).collect()
    one = next(r for r in rows if r["id"] == 1)
    assert (one["words"], one["lines"], one["lines_stopped"], one["common_share"]) == (4, 2, 0.5, 0.25) and len(rows) == 4
    assert next(r for r in rows if r["id"] == 2)["words"] == 0
    assert Q.text_quality(df.limit(0), F.col("text"), read_table(spark, SF, "common_word"), ["kind"]).count() == 0


def test_divergence_is_that_of_the_dense_distributions():
    import numpy as np

    q = np.array([[0.2, 0.3, 0.1, 0.4]])
    got = Q.word_divergence(np.array([0, 0]), np.array([0, 2]), np.array([3.0, 1.0]), np.array([10.0]), np.array([0]), q)
    p = np.array([0.3, 0.0, 0.1, 0.6])
    assert abs(got[0] - Q.divergence(p, q[0])) < 1e-12


def test_no_line_test_is_skipped(monkeypatch):
    texts = {
        "csv": "a1,b2,c3,d4\ne5,f6,g7,h8\ni9,j1,k2,l3\nm4,n5,o6,p7", "log": "2024-01-02 10:11 started the job\n2024-01-02 10:12 ended the job", "slash": " / ".join(["home", "menu", "shop", "news"] * 5) + " / home",
        "dots": " · ".join(["home", "menu", "shop", "news"] * 5) + " · home", "rule": "some words here\n==========\nother words there", "fence": "un mot\n~~~\ncode\n~~~\nfin", "cells": "ab;cd;ef", "prose": "Il pleut sur la ville. Le chat dort, comme toujours.\nOn attend.",
    }
    quick = {k: Q.structure(t) for k, t in texts.items()}
    monkeypatch.setattr(Q, "_odd", lambda *_: True)
    assert quick == {k: Q.structure(t) for k, t in texts.items()}
    assert quick["csv"][2] > 0 and quick["log"][3] > 0 and quick["slash"][3] > 0 and quick["dots"][3] > 0 and quick["prose"][0] > 0
    late = " / ".join(["home", "menu", "shop", "news"] * 10) + " / 2024"
    assert Q.structure(late)[3] == 0


def test_words_mixed_with_digits_and_stops_count():
    assert Q.count_text("le ch4t d.rt dans la m41son", Q.Vocabulary([("le", "fr"), ("la", "fr")]))[0][Q._NUMBERS.index("mixed")] == 3
