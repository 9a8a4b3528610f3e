"""Packing, mixing and names against brute force and on edge cases."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from notewright.llm import mixing as M
from notewright.llm import names as N
from notewright.llm import packing as P
from notewright.llm import tokens as K

WORDS = "le chat dort dans une maison et la pluie tombe sur les toits du village voisin".split()


def text(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def test_token_sizes_are_those_of_the_tokenizer(spark):
    df = spark.createDataFrame([(1, "le chat"), (2, None), (3, ""), (4, "<|endoftext|>")], "id int, text string")
    got = {r["id"]: r["tokens"] for r in K.token_sizes(df, F.col("text"), [F.col("id")]).collect()}
    assert got == {1: len(K.encoder(K.VOCABULARY).encode_ordinary("le chat")), 2: 0, 3: 0, 4: len(K.encoder(K.VOCABULARY).encode_ordinary("<|endoftext|>"))}


@pytest.mark.parametrize("bucket_rows", [7, 1000])
def test_ranks_within_a_hot_group(spark, bucket_rows):
    rows = [("hot" if i % 3 else f"g{i % 5}", i) for i in range(300)]
    got = K.rank_within(spark.createDataFrame(rows, "g string, id int"), ["g"], ["id"], 300, bucket_rows=bucket_rows).collect()
    for g in {r["g"] for r in got}:
        mine = sorted(r["rank"] for r in got if r["g"] == g)
        assert mine == list(range(len(mine)))
    other = K.rank_within(spark.createDataFrame(rows, "g string, id int"), ["g"], ["id"], 300, bucket_rows=50).collect()
    assert {(r["id"], r["rank"]) for r in other} == {(r["id"], r["rank"]) for r in got}  # the same places whatever the buckets


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(0, 50), st.integers(1, 40), max_size=20))
def test_plans_place_every_item_once_and_overfill_nothing(counts):
    runs = P.plan_packing(counts, 50)
    used: dict[int, list[tuple[int, int]]] = {}
    seen = {length: 0 for length in counts}
    for length, a, b, first, each, offset in sorted(runs):
        assert a == seen[length]
        seen[length] = b
        for k in range(b - a):
            used.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert seen == counts
    for slots in used.values():
        at = 0
        for offset, length in sorted(s for s in slots if s[1]):
            assert offset == at
            at += length
        assert at <= 50
    total = sum(k * v for k, v in counts.items())
    assert sum(1 for s in used.values() if any(x[1] for x in s)) <= 2 * total / 50 + 1


def test_pack(spark):
    rnd = random.Random(4)
    docs = [(i, text(rnd, rnd.choice([0, 3, 20, 20, 20, 400]))) for i in range(120)] + [(500, None), (501, ""), (7, "le chat"), (7, "le chat")]
    df = spark.createDataFrame(docs, "doc_id long, body string")
    got = P.pack(df, F.col("body"), F.col("doc_id"), [("s", 64), ("l", 300)]).collect()
    for spec, cap in (("s", 64), ("l", 300)):
        mine = [r for r in got if r["spec"] == spec]
        assert sum(r["part"] == 0 for r in mine) == len(docs)
        room: dict[int, int] = {}
        for r in sorted(mine, key=lambda r: (r["container"], r["offset"])):
            if r["tokens"]:
                assert r["offset"] == room.get(r["container"], 0)
                room[r["container"]] = r["offset"] + r["tokens"]
        assert max(room.values()) <= cap
        size = K.encoder(K.VOCABULARY).encode_ordinary
        assert sum(r["tokens"] for r in mine) == sum(len(size(t)) for _, t in docs if t)
    assert P.pack(df.limit(0), F.col("body"), F.col("doc_id"), [("s", 64)]).count() == 0


def test_mix_reaches_the_shares_within_the_caps(spark):
    rnd = random.Random(5)
    docs = [(i, text(rnd, rnd.randint(5, 60)) + f" {i}", rnd.choice("aabbbbbbc")) for i in range(900)] + [(1000, None, "a"), (1001, "", "b"), (1002, "même texte", "a"), (1003, "même texte", "b"), (1004, "z", None), (1005, "x y", "unlisted")]
    df = spark.createDataFrame(docs, "doc_id long, body string, src string")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.2, 4), ("gone", 0.1, 1), (None, 0.1, 1), ("none", None, None)], "source string, target_share double, max_repeat int")
    got = M.mix(df, F.col("body"), F.col("doc_id"), F.col("src"), targets).collect()
    tokens = {s: sum(r["tokens"] * r["copies"] for r in got if r["source"] == s) for s in "abc"}
    total = sum(tokens.values())
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(tokens[s] / total - share) < 0.01
        assert max(r["copies"] for r in got if r["source"] == s) <= {"a": 2, "b": 1, "c": 4}[s]
    ids = {r["doc_id"] for r in got}
    assert not ids & {1000, 1001, 1003, 1004, 1005} and len(ids) == len(got)
    shares = {r["source"]: r["texts"] for r in M.shares_reached(spark.createDataFrame(got), targets).collect()}
    assert shares["gone"] == 0 and sum(shares.values()) == len(got)
    assert M.mix(df.limit(0), F.col("body"), F.col("doc_id"), F.col("src"), targets).count() == 0


def test_jaro_winkler_and_edits():
    assert abs(N.jaro_winkler("martha", "marhta") - 0.9611) < 1e-4 and abs(N.jaro_winkler("dixon", "dicksonx") - 0.8133) < 1e-4
    assert N.jaro_winkler("", "a") == 0 and N.edits("abcd", "abdc", 2) == 1 and N.edits("abc", "xyz", 2) == 3


SAME = [
    ["Benjamin Raplanbroibis", "Benjamin C. Raplanbroibis", "Ben Raplanbroibis", "RAPLANBROIBIS, Benjamin", "Raplanbroibis (Ben)", "Benamin Raplanbroibis", "b.raplanbroibis", "Benjaminraplanbroibis", "Dr. Benjamin Raplanbroiibs"],
    ["Bureau d'études Lupizoife Conseil", "BE Lupizoife Conseil", "Lupizoife (bureau d'études)", "BC. Lupizoife", "Bureau d'etudes Lupizoife Conseil SAS"],
    ["Marie-Claude Grounuloitras"], ["Patricia Grounuloitras"], ["René Garoudubrous"], ["Renée Garoudubrous"], ["Groupe Cepetoifois Logistique"], ["Groupe Cepetoifois Énergie"],
]


def clusters(spark, rows):
    df = spark.createDataFrame(rows, "slug string, kind string, name string, alias boolean")
    return {r["slug"]: r["component"] for r in N.link_names(df, N.known_first_names(df)).collect()}


def test_variants_are_linked_and_others_not(spark):
    rows = [(f"{i}-{j}", "organisation" if i in (1, 6, 7) else "personne", n, False) for i, names in enumerate(SAME) for j, n in enumerate(names)]
    got = clusters(spark, [*rows, *rows])
    for i, names in enumerate(SAME):
        assert len({got[f"{i}-{j}"] for j in range(len(names))}) == 1, names
    assert len(set(got.values())) == len(SAME)


def test_a_surname_shared_by_two_people_links_neither(spark):
    got = clusters(spark, [("a", "personne", "Marie-Claude Grounuloitras", False), ("b", "personne", "Patricia Grounuloitras", False), ("c", "personne", "Grounuloitras", False), ("d", "personne", "Agent Secret", False), ("d", "personne", "Patricia Grounuloitras", True)])
    assert got["a"] != got["b"] and got["c"] not in (got["a"], got["b"]) and got["d"] == got["b"]


def test_large_blocks_are_divided_without_loss(spark):
    rnd = random.Random(6)
    cores = ["".join(rnd.choice(["ba", "be", "bi", "bo"]) for _ in range(4)) for _ in range(60)]
    df = spark.createDataFrame([("personne", "bbbb", c) for c in sorted(set(cores))], "kind string, key string, core string")
    every = {(r["a"], r["b"]) for r in N.core_pairs(df, most=1000).collect()}
    some = {(r["a"], r["b"]) for r in N.core_pairs(df, most=5).collect()}
    assert {p for p in every if N.same_core(*p)} == {p for p in some if N.same_core(*p)}


def test_spellings_that_can_be_one_share_a_key():
    rnd = random.Random(8)
    pairs = [("tousuzoige", "tousuzoigre"), ("dubois", "duois"), ("simon", "sinon"), ("bibrimouju", "bibrirnouju"), ("a b", "ab")]
    for _ in range(1500):
        a = "".join(rnd.choice("aegjklmnrstu") for _ in range(rnd.choice([3, 5, 7, 8, 9, 10, 14, 38, 39, 40, 41, 42, 43, 44, 90])))
        b = list(a)
        for _ in range(rnd.choice([1, 2, 2])):
            i = rnd.randrange(len(b) - 1)
            b[i : i + 2] = rnd.choice([[b[i + 1], b[i]], [b[i + 1]], ["x", b[i + 1]], [b[i], "y", b[i + 1]]])
        pairs.append((a, "".join(b)))
    same = [p for p in pairs if N.same_core(*p)]
    assert len(same) > 500 and all(set(N.spelling_keys(a)) & set(N.spelling_keys(b)) for a, b in same)
    assert len(N.spelling_keys("x" + "abcdefghij" * 500)) < 200


def test_one_slip_that_changes_two_sounds_is_found(spark):
    names = ["Groupe Tousuzoige Maintenance", "Groupe Tousuzoigre Maintenance"], ["Robert Dubois", "Robert Duois"], ["Robert Simon", "Robert Sinon"]
    got = clusters(spark, [(f"{i}-{j}", "personne" if i else "organisation", n, False) for i, two in enumerate(names) for j, n in enumerate(two)])
    assert all(got[f"{i}-0"] == got[f"{i}-1"] for i in range(3)) and len(set(got.values())) == 3


def test_agreeing_forms_are_those_of_all_pairs_though_a_surname_is_hot(spark):
    rnd = random.Random(11)
    firsts = ["".join(rnd.choice("abeilmnorst") for _ in range(rnd.randint(4, 9))) for _ in range(40)]
    firsts += [f[:2] + "x" + f[2:] for f in firsts[:15]] + ["", "a", "b"]
    forms = sorted({("personne", c, f, m) for c in ("dupont", "dupond", "autre") for f in rnd.sample(firsts, 40) for m in rnd.choice([("",), ("", "k")])} | {("organisation", "dupont", k, w) for k in ("", "g", "groupe") for w in ("", "conseil")})
    df = spark.createDataFrame(forms, "kind string, core string, q1 string, q2 string")
    near = spark.createDataFrame([(k, a, b) for k in ("personne", "organisation") for a, b in (("dupont", "dupont"), ("dupond", "dupond"), ("autre", "autre"), ("dupont", "dupond"), ("dupond", "dupont"))], "kind string, a string, b string")
    got = {(r["kind"], (r["a"], r["p1"], r["p2"]), (r["b"], r["q1"], r["q2"])) for r in N.agreeing_forms(df, near).collect()}
    close = {("dupont", "dupond"), ("dupond", "dupont")}
    for kind, a, p1, p2 in forms:
        for k, b, q1, q2 in forms:
            if k == kind and (a == b or (a, b) in close) and (a, p1, p2) != (b, q1, q2) and N.agree(kind, (p1, p2), (q1, q2)) and (kind != "personne" or len(p1) <= 1 or len(q1) > 1):
                assert (kind, (a, p1, p2), (b, q1, q2)) in got
    assert all(N.agree(k, x[1:], y[1:]) for k, x, y in got)


def test_first_names_are_told_by_where_they_stand(spark):
    rows = [(f"s{i}", "personne", f"Zéphirin Nom{'abcdefgh'[i]}eux", False) for i in range(8)] + [("t", "personne", "Nomaeux Zéphirin", False), ("u", "personne", None, False), ("v", "organisation", "Groupe Zed", False)]
    df = spark.createDataFrame(rows, "slug string, kind string, name string, alias boolean")
    known = {r["first"]: r["n"] for r in N.known_first_names(df).collect()}
    assert known["zephirin"] == 8 and "nomaeux" not in known and "thomas" in known
    table = spark.createDataFrame(list(known.items()), "first string, n long")
    asked = spark.createDataFrame([("zephirin",), ("zephirim",), ("tom",), ("annesophie",), ("zz",), ("qqqqqqq",)], "token string")
    got = {r["token"]: (r["formal"], r["how"]) for r in N.first_name_readings(asked, table).collect()}
    assert got == {"zephirin": ("zephirin", "known"), "zephirim": ("zephirin", "near"), "tom": ("thomas", "known"), "annesophie": ("anne-sophie", "glued")}


def test_components_against_union_find(spark):
    rnd = random.Random(7)
    edges = [(f"n{rnd.randrange(80)}", f"n{rnd.randrange(80)}") for _ in range(55)] + [(f"c{i}", f"c{i + 1}") for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {n: find(n) for e in edges for n in e if e[0] != e[1] or find(n) != n}
    got = {r["node"]: r["component"] for r in N.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {n: c for n, c in got.items() if n in want} == {n: c for n, c in want.items() if n in got}
    assert all(n in got for e in edges if e[0] != e[1] for n in e)


def test_loops_that_do_not_converge_are_errors(spark):
    chain = spark.createDataFrame([(f"c{i:02d}", f"c{i + 1:02d}") for i in range(40)], "a string, b string")
    with pytest.raises(RuntimeError, match="rounds"):
        N.connected_components(chain, rounds=1)
    h = spark.createDataFrame([("a", 5, 10), ("a", 50, 10)], "source string, tokens long, texts long")
    with pytest.raises(RuntimeError, match="steps"):
        M.solve_tilts(h, {"a": 100.0}, {"a": 2}, {"a": (550, 20)}, steps=1)
    assert M.solve_tilts(h, {"a": 100.0}, {"a": 2}, {"a": (550, 20)})["a"][0] == 2


def test_names_edge_cases(spark):
    assert N.read_person("Dr.", N.FirstNames([])) is None and N.read_person("   ", N.FirstNames([])) is None
    assert N.read_organisation("Société") is None
    from notewright.sources import read_table

    e = read_table(spark, "/root/testdata/sf0.001", "envelope").limit(0)
    names = N.typed_names(e)
    assert N.slug_pairs(N.link_names(names, N.known_first_names(names))).count() == 0
