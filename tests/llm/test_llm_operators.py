import random
import unicodedata


import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipwright.llm import bpe, cap, clusters, level, lookalike, mixture, overlap, related
from tests.helpers import DATA

EDGE_TEXTS = [(1, None), (2, ""), (3, " \t "), (4, "same words here"), (4, "same words here"), (5, "x" * 300_000), (6, "word " * 50_000)]


# 1: related splits
def connected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(120):03d}", f"n{rng.randrange(120):03d}") for _ in range(90)] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(40)] + [("hub", f"h{i}") for i in range(60)] + [("alone", "alone")]
    got = {r["node"]: r["root"] for r in related.components(spark.createDataFrame([*edges, *edges[:20], (None, "x")], "a string, b string")).collect()}
    assert got == connected(edges)


def test_components_of_nothing(spark):
    assert related.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_related_split_edges(spark):
    rows = [(1, " Ann ", 7, "x"), (2, "ann", -1, "x"), (3, "UNKNOWN ", 7, "x"), (4, None, None, "x"), (4, None, None, "x"), (5, "", -1, "x"), (6, "bob", None, "x")]
    df = spark.createDataFrame(rows, "row_id int, who string, idx int, component string")
    keys = {"who": related.name_key("who"), "idx": related.index_key("idx")}
    out = related.related_splits(df, keys, record="row_id", proportions={"train": 8, "test": 2}, seed=1).collect()
    comp = {r["row_id"]: r["component"] for r in out}
    assert len(out) == 7 and comp[1] == comp[2] == comp[3] and len({comp[i] for i in (1, 4, 5, 6)}) == 4
    assert related.related_splits(df.limit(0), keys, record="row_id", proportions={"train": 1}).count() == 0
    many = spark.range(3000).select(F.col("id").alias("row_id"), F.concat(F.lit("s"), (F.col("id") % 1000).cast("string")).alias("who"))
    got = related.related_splits(many, {"who": related.name_key("who")}, record="row_id", proportions={"train": 0.8, "test": 0.2}).groupBy("related_split").count().collect()
    assert abs({r["related_split"]: r["count"] for r in got}["train"] / 3000 - 0.8) < 0.05
    with pytest.raises(ValueError):
        related.related_splits(df, keys, record="row_id", proportions={"a": 0})


# 2: caps
@given(st.integers(0, 60), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 9)), min_size=1, max_size=6))
def test_quotas(slots, strata):
    sizes, weights = [a for a, _ in strata], [float(b) for _, b in strata]
    got = cap.quotas(slots, sizes, weights)
    assert sum(got) == min(slots, sum(sizes)) and all(0 <= g <= s for g, s in zip(got, sizes, strict=True))


def test_apportion_by_largest_remainder():
    assert cap.apportion(10, [1, 1, 1]) == [4, 3, 3] and cap.apportion(7, [5, 3, 1]) == [4, 2, 1] and cap.apportion(0, [1]) == [0]
    assert cap.quotas(10, [1, 20, 20], [1, 1, 1]) == [1, 5, 4]


def test_cap_edges(spark):
    rows = [(f"r{i}", "hot", q, s) for i, (q, s) in enumerate([(5.0, "a"), (5.0, "a"), (None, "a"), (float("nan"), "b"), (9.0, "b"), (1.0, None)])] + [("n1", None, 1.0, "a"), ("n2", None, None, "a"), ("c", "cold", None, "a")]
    df = spark.createDataFrame(rows, "id string, who string, q double, kept string")
    run = lambda n, **k: {r["id"] for r in cap.cap_contributors(df, contributor=F.col("who"), quality=F.col("q"), record="id", max_count=n, **k).filter("not kept").collect()}
    assert run(2) == {"r1", "r2", "r3", "r5"} and run(0) == {"r0", "r1", "r2", "r3", "r4", "r5", "c"} and run(9) == set()
    assert run(3, strata=F.col("kept"), weighting="equal") == {"r1", "r2", "r3"}
    assert cap.cap_contributors(df.limit(0), contributor=F.col("who"), quality=F.col("q"), record="id", max_share=0.1).count() == 0
    assert cap.latest(spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("a", None, 9), (None, 1, 1)], "k string, t int, r int"), "k", ["t", "r"]).count() == 2


# 4: look-alikes
def independent_form(t):
    """Equality of look without the lattice: one stand-in for each class, by hand."""
    stand = str.maketrans("АВСЕНІЈКМОРЅТХУаеорсухѕіјһԁԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϳօɡ‐", "ABCEHIJKMOPSTXYaeopcyxsijhdwABEZHIKMNOPTYXojog-")
    t = "".join(" " if c.isspace() else c for c in t if c.isspace() or (unicodedata.category(c) not in ("Cf", "Cc") and not 0xFE00 <= ord(c) <= 0xFE0F and c != "͏"))
    t = t.replace("ϲ", "c").replace("Ϲ", "C").replace("ρ", "p")
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKD", t).translate(stand)).strip()


def test_lookalike_pairs_equal_all_pairs(spark):
    folder = DATA.replace("sf0.001", "sf0.01")
    rows = duckdb.sql(f"SELECT row_id, transcription FROM '{folder}/clips_text.parquet' WHERE transcription IS NOT NULL").fetchall()
    forms = {}
    for r, t in rows:
        forms.setdefault(independent_form(t), []).append((r, t))
    want = {(min(a, b), max(a, b)) for f, g in forms.items() if f for a, t in g for b, u in g if a != b and t != u}
    got = lookalike.lookalike_pairs(spark.read.parquet(f"{folder}/clips_text.parquet"), "transcription", "row_id").collect()
    assert {(r["row_id_a"], r["row_id_b"]) for r in got} == want and len(got) == len(want)


@settings(max_examples=200)
@given(st.text(alphabet="abcehopxy АВсеаοορｐé́̈​­͏ -‐KK ", max_size=20))
def test_canonical_is_stable(text):
    model = lookalike.Model(dict(lookalike.token_bigrams(["hope", "cab", "xyo"])))
    once = model.canonical(text)
    assert model.canonical(once) == once
    assert (lookalike.skeleton(lookalike.fold(text)) == "") == (once == "")


def test_script_consistent_spelling():
    model = lookalike.Model(dict(lookalike.token_bigrams(["cope", "hope", "pace"] * 9 + ["сорока", "рука"] * 9)))
    assert model.canonical("сopе") == "cope" and model.canonical("pукa") == "рука"
    assert model.canonical("ᎪᏴ") == model.canonical("AB") == model.canonical("ꓮꓐ")


def test_spelling_follows_neighbouring_letters():
    """A token of look-alikes only takes the script whose bigrams the corpus has; beside other letters theirs."""
    latin = lookalike.Model(dict(lookalike.token_bigrams(["cap", "pace", "trace", "cart"] * 9)))
    cyrillic = lookalike.Model(dict(lookalike.token_bigrams(["сор", "роса", "хор"] * 9)))
    assert latin.canonical("сар") == "cap" and cyrillic.canonical("pоca") == "роса"
    assert lookalike.kind("t") == "t" and lookalike.kind("т") == "т" and lookalike.kind("日") == "*CJK"


def test_lookalike_classes_of_hot_texts(spark):
    """A third of the rows hold one text, and as many its look-alike: the pairs are those of the two texts, whatever the copies."""
    rows = [(i, "same") for i in range(60)] + [(100 + i, "sаme") for i in range(50)] + [(200 + i, f"own {i}") for i in range(60)] + [(0, "same"), (None, "same")]
    df = spark.createDataFrame(rows, "r long, t string")
    assert lookalike.lookalike_pairs(df, "t", "r").count() == 60 * 50
    assert lookalike.lookalike_classes(df, "t", "r").select("form").distinct().count() == 61


def test_canonical_edges(spark):
    df = spark.createDataFrame([*EDGE_TEXTS, (7, "​⁠ ")], "i int, t string")
    got = {r["i"]: r["canonical"] for r in lookalike.canonical_text(df, "t").collect()}
    assert got[1] is None and got[2] == got[3] == got[7] == "" and got[4] == "same words here" and len(got[5]) == 300_000
    assert lookalike.lookalike_pairs(df, "t", "i").count() == 0 and lookalike.lookalike_pairs(df.limit(0), "t", "i").count() == 0


# 5: overlaps
@settings(max_examples=150)
@given(st.lists(st.sampled_from("abcdef"), max_size=20), st.lists(st.sampled_from("abcdef"), max_size=20), st.integers(0, 4))
def test_within_edits(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    assert overlap.within_edits(a, b, most) == (row[-1] <= most)


def test_sketch_misses_nothing(spark):
    rng = random.Random(5)
    rows = []
    for i in range(250):
        w = [rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randint(1, 40))]
        rows.append((len(rows), " ".join(w), rng.choice([0, 0, 1])))
        for _ in range(2):
            v = list(w)
            for _ in range(rng.randint(0, 1 + len(w) // 7)):
                k = rng.randrange(len(v)) if v else 0
                rng.choice([lambda: v.insert(k, "new"), lambda: v.__setitem__(k, "other") if v else None, lambda: v.pop(k) if v else None])()
            rows.append((len(rows), " ".join(v), rng.choice([0, 1])))
    df = spark.createDataFrame(rows, "r long, t string, side int")
    for rule in (overlap.Rule(2, None, 8), overlap.Rule(2, 0.8), overlap.Rule(5, 0.8)):
        members, pairs = overlap.cross_overlaps(df, rule, record="r", text="t", side="side")
        got = {(r["row_id_a"], r["row_id_b"]) for r in overlap.record_pairs(members, pairs).collect()}
        want = {(min(a, b), max(a, b)) for a, t, s in rows for b, u, z in rows if s == 0 and z == 1 and t and u and (t == u or rule.near(t, u))}
        assert got == want and want


def test_bands_alone_find_most(spark):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(4000)}" for _ in range(24)] for _ in range(300)]
    rows = [(i, " ".join(w), 0) for i, w in enumerate(base)] + [(1000 + i, " ".join([*w[:11], "other", *w[12:]]), 1) for i, w in enumerate(base)]
    df = spark.createDataFrame(rows, "r long, t string, side int")
    found = {}
    for complete in (False, True):
        members, pairs = overlap.cross_overlaps(df, overlap.Rule(2, None, 8), record="r", text="t", side="side", complete=complete)
        found[complete] = {(r["row_id_a"], r["row_id_b"]): r["jaccard"] for r in overlap.record_pairs(members, pairs).collect()}
    assert found[True] == {(i, 1000 + i): 21 / 25 for i in range(300)}
    assert found[False].items() <= found[True].items() and len(found[False]) > 0.9 * 300


def test_overlap_edges(spark):
    df = spark.createDataFrame([(i, t, i % 2) for i, t in EDGE_TEXTS] + [(8, "Same, WÓRDS here!", 1), (9, "same words here", None), (10, "!!", 0), (11, "??", 1)], "r long, t string, side int")
    members, pairs = overlap.cross_overlaps(df, overlap.Rule(2, None, 8), record="r", text="t", side="side")
    assert {(r["row_id_a"], r["row_id_b"]) for r in overlap.record_pairs(members, pairs).collect()} == {(4, 8)}
    members, pairs = overlap.cross_overlaps(df.limit(0), overlap.Rule(), record="r", text="t", side="side")
    assert pairs.count() == 0 and members.count() == 0


def test_very_long_near_texts(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(9000)}" for _ in range(30_000)]
    other = ["first", *words[:20_000], "more", *words[20_001:-1], "last"]
    df = spark.createDataFrame([(1, " ".join(words), 0), (0, " ".join(other), 1), (1, " ".join(words), 0)], "r long, t string, side int")
    members, pairs = overlap.cross_overlaps(df, overlap.Rule(2, None, 8), record="r", text="t", side="side")
    assert [(r["row_id_a"], r["row_id_b"], r["exact"]) for r in overlap.record_pairs(members, pairs).collect()] == [(0, 1, False)]


# 6: clusters
def test_clusters_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for v in range(40):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 12)) if v else 400):  # one voice holds more than half of all rows
            rows.append((f"c{len(rows):04d}", [float(x) for x in centre / np.linalg.norm(centre) + rng.normal(0, 0.07, 16)]))
    rows += [("z0", [0.0] * 16), ("z1", None), ("z2", [float("nan")] * 16), ("z3", [1.0] * 3), ("c0000", rows[0][1])]
    df = spark.createDataFrame(rows, "source_id string, embedding array<float>")
    got = {r["record"]: r["cluster_key"] for r in clusters.similarity_clusters(df, record="source_id", vector="embedding", dims=16).collect()}
    good = rows[: len(rows) - 5]
    x = np.asarray([v for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = connected([(good[i][0], good[j][0]) for i, j in zip(*np.nonzero(x @ x.T >= 0.8), strict=True)])
    assert got == want


def joined(names, x, least):
    return connected([(names[i], names[j]) for i, j in zip(*np.nonzero(x @ x.T >= least), strict=True)])


@pytest.mark.parametrize(("few", "block", "cells"), [(8192, 8192, None), (40, 8192, None), (40, 30, 12), (10_000, 50, 5), (10, 8192, 3)])
def test_clusters_equal_all_pairs_in_blocks_and_rounds(spark, few, block, cells):
    """One group with a third of all rows, groups of all sizes, loose chains with links of 0.80 to 0.85, rows far from all others."""
    rng = np.random.default_rng(6)
    unit = lambda a: a / np.linalg.norm(a, axis=-1, keepdims=True)
    dims, parts = 12, []
    parts.append(unit(rng.normal(size=dims)) + rng.normal(0, 0.05, (260, dims)))
    for _ in range(40):
        parts.append(unit(rng.normal(size=dims)) + rng.normal(0, rng.choice([0.03, 0.08, 0.12]), (int(rng.integers(1, 14)), dims)))
    for _ in range(12):  # a chain: each step turns by an angle of cosine 0.80 to 0.85 in a direction of its own
        at, chain = unit(rng.normal(size=dims)), []
        for _ in range(8):
            chain.append(at)
            side = rng.normal(size=dims)
            side = unit(side - (side @ at) * at)
            c = rng.uniform(0.801, 0.85)
            at = unit(c * at + np.sqrt(1 - c * c) * side)
        parts.append(np.stack(chain))
    x = unit(np.concatenate(parts)).astype(np.float32)
    names = [f"c{i:04d}" for i in rng.permutation(len(x))]
    df = spark.createDataFrame([(n, [float(v) for v in r]) for n, r in zip(names, x, strict=True)], "source_id string, embedding array<float>")
    got = {r["record"]: r["cluster_key"] for r in clusters.similarity_clusters(df, record="source_id", vector="embedding", dims=None, few=few, block=block, cells=cells).collect()}
    assert got == joined(names, x, 0.8)


def test_alike_pairs_meet_in_a_cell():
    rng = np.random.default_rng(8)
    unit = lambda a: (a / np.linalg.norm(a, axis=1, keepdims=True)).astype(np.float32)
    for dims, spread in ((3, 0.5), (8, 0.25), (8, 1.0), (32, 0.1)):
        x = unit(np.repeat(rng.normal(size=(60, dims)) / np.sqrt(dims), 20, axis=0) + rng.normal(0, spread / np.sqrt(dims), (1200, dims)))
        c = unit(np.concatenate([x[rng.choice(len(x), 24, replace=False)], rng.normal(size=(4, dims))]))
        for least in (0.5, 0.8, 0.95):
            a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
            home, guests = clusters.border_cells(x, c, least)
            inside = np.zeros((len(x), len(c)), bool)
            inside[np.arange(len(x)), home] = True
            for i, g in enumerate(guests):
                inside[i, g] = True
            assert len(a) and (inside[a, home[b]] | inside[b, home[a]]).all()
            # each pair with one in a core: the other is in that core, alike to its pivot, or a guest
            near = (x @ c.T).argmax(axis=0)
            cores = clusters.Cores(c, [str(i) for i in near], x[near], least)
            home, linked, guests = cores.place(x)
            known = np.zeros((len(x), len(cores.centroids)), bool)
            known[linked] = known[guests] = True
            for p, q in ((a, b), (b, a)):
                held = home[p] >= 0
                assert known[q[held], home[p[held]]].all()
            for i in np.unique(home[home >= 0]):
                members = x[home == i]
                assert (members @ members.T >= least - 1e-6).all()


def test_links_far_from_a_border(spark):
    """Two groups a right angle apart, and a chain between them whose middle link crosses the border with both ends 0.3 away from it."""
    angles = [*np.linspace(0, 2, 30), 27.0, 63.0, *np.linspace(88, 90, 30)]
    rows = [(f"c{i:02d}", [float(np.cos(np.radians(a))), float(np.sin(np.radians(a)))]) for i, a in enumerate(angles)]
    got = clusters.similarity_clusters(spark.createDataFrame(rows, "source_id string, embedding array<float>"), record="source_id", vector="embedding", dims=2, cells=2).collect()
    assert {r["record"]: r["cluster_key"] for r in got} == dict.fromkeys((r for r, _ in rows), "c00")


def test_cluster_edges(spark):
    empty = spark.createDataFrame([], "source_id string, embedding array<float>")
    assert clusters.similarity_clusters(empty, record="source_id", vector="embedding").count() == 0
    one = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0, 0.0]), (None, [1.0, 0.0])], "source_id string, embedding array<float>")
    got = {r["record"]: r["cluster_key"] for r in clusters.similarity_clusters(one, record="source_id", vector="embedding", dims=2).collect()}
    assert got == {"a": "a", "b": "a"}
    texts = spark.createDataFrame([("a", "red red house"), ("b", "red house red"), ("c", "blue sea"), ("d", None)], "i string, t string")
    f = clusters.hashed_features(texts, "t", dims=64)
    got = {r["record"]: r["cluster_key"] for r in clusters.similarity_clusters(f, record="i", vector="embedding").collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}


# 7: encoding
@pytest.fixture(scope="module")
def encoder():
    data, split = bpe.tables(bpe.VOCABULARY)
    return bpe.Encoder(bpe.load_ranks(data), split)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_plain_merging(encoder, text):
    rank = {t: i for i, t in enumerate(encoder.tokens)}
    want = [rank[p] for piece in encoder.find(text) for p in bpe.merge_by_rank(piece.encode("utf-8", "replace"), rank)]
    assert encoder.encode(text) == want
    assert encoder.decode(want) == text.encode("utf-8", "replace")


def test_encoding_edges(spark, encoder):
    df = spark.createDataFrame([(i, t, "k") for i, t in EDGE_TEXTS] + [(8, "<|endoftext|>", "k")], "i int, t string, ids string")
    got = {r["i"]: r["ids"] for r in bpe.encode_corpus(df, "t", "ids").collect()}
    assert got[1] == got[2] == [] and encoder.decode(got[5]) == b"x" * 300_000 and encoder.decode(got[8]) == b"<|endoftext|>" and len(got[8]) > 1
    counts = {r["i"]: r["tokens"] for r in bpe.token_counts(df, "t").collect()}
    assert counts == {i: len(x) for i, x in got.items()}
    assert bpe.encode_corpus(df.limit(0), "t", "ids").count() == 0


# 8: mixtures
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 50)), min_size=1, max_size=6), st.integers(0, 200))
def test_fill(kids, budget):
    w, c = [float(a) for a, _ in kids], [b for _, b in kids]
    got = mixture.fill(w, c, budget)
    assert abs(sum(got) - min(budget, sum(c))) < 1e-6 and all(-1e-9 <= g <= x + 1e-9 for g, x in zip(got, c, strict=True))


def test_shortage_stays_among_siblings():
    leaf = lambda w, t: mixture.Node(w, t)
    root = mixture.Node(1, children={"a": mixture.Node(0.5, children={"x": leaf(0.25, 10), "y": leaf(0.25, 90)}), "b": mixture.Node(0.5, children={"z": leaf(0.5, 100)})})
    assert mixture.allocate(root, 100) == {("a", "x"): 10, ("a", "y"): 40, ("b", "z"): 50}
    root.children["a"].children["y"].tokens = 20
    assert mixture.allocate(root, 100) == {("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 70}
    assert mixture.feasible_total(root) == 40


def test_tree_of_domains_languages_sources():
    leaves = {("spoken", "sn", "talks"): 100, ("spoken", "en", "talks"): 300, ("spoken", "sn", "tales"): 50, ("written", "en", "notes"): 400}
    targets = {"talks": (0.5, 1), "tales": (0.25, 2), "notes": (0.25, 1)}
    root = mixture.weight_tree(leaves, targets)
    weights = {p: n.weight for p, n in mixture.leaves_of(root)}
    assert weights == {("spoken", "en", "talks"): 0.375, ("spoken", "sn", "talks"): 0.125, ("spoken", "sn", "tales"): 0.25, ("written", "en", "notes"): 0.25}
    assert root.children["spoken"].weight == 0.75 and root.children["spoken"].children["sn"].weight == 0.375
    total = mixture.feasible_total(root)
    assert total == 400  # all of the tales, twice
    got = mixture.allocate(root, total)
    assert got == {p: w * total for p, w in weights.items()}
    # beyond it tales fall short, and talks of their language take what they can, then the domain's other language, then the other domain
    got = mixture.allocate(root, 700)
    assert got["spoken", "sn", "tales"] == 100 and got["spoken", "sn", "talks"] == 100 and got["spoken", "en", "talks"] == 300 and abs(got["written", "en", "notes"] - 200) < 1e-9
    rows = {r[:4]: r[4:] for r in mixture.node_rows(root, 700, got)}
    assert rows["language", "spoken", "sn", None][1:] == (262.5, 200, 200.0) and rows["domain", "spoken", None, None][3] == 500 and rows["all", None, None, None][3] == 700
    equal = mixture.weight_tree(leaves, targets, {"sn": 1.0, "en": 1.0})
    assert equal.children["spoken"].children["en"].weight == 0.25


def test_language_and_source_keys(spark):
    df = spark.createDataFrame([(" Sna\xa0", "Radio - Talks"), ("EN_zw", "\xa0radio_talks "), ("nde", " "), (None, None), ("xx", "a b")], "l string, s string")
    got = [tuple(r) for r in df.select(mixture.language_key("l"), mixture.source_key("s")).collect()]
    assert got == [("sn", "radio_talks"), ("en", "radio_talks"), ("nd", None), ("other", None), ("other", "a_b")]


def test_mixture_edges(spark):
    rows = [(i, "word " * 20, " Radio-Talks ", "SN") for i in range(50)] + [(100 + i, "other words " * 10, "notes", None) for i in range(3)] + [(200, None, "notes", "en"), (201, "", "notes", "en"), (202, "x", None, "en"), (203, "x", "unlisted", "en")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, lang string")
    targets = {"radio_talks": (0.5, 1), "notes": (0.4, 4), "absent": (0.1, 2)}
    run = lambda d, **k: mixture.mix_sources(d, targets, record="doc_id", text="text", source=mixture.source_key("source"), language=mixture.language_key("lang"), **k)
    mix = run(df)
    shares = {r["source"]: r for r in mix.shares.collect()}
    assert shares["absent"]["used_tokens"] == 0 and shares["notes"]["most_copies"] == 4 and abs(shares["radio_talks"]["actual_share"] - 5 / 9) < 0.05
    big = run(df, total_tokens=10**9)
    assert {r["copies"] for r in big.records.filter("source = 'radio_talks'").collect()} == {1} and big.records.count() == 53
    assert run(df.limit(0)).shares.agg(F.sum("used_tokens")).first()[0] == 0


# 9: reading level
def test_held_out_levels():
    rows = duckdb.sql(f"SELECT text, level FROM '{DATA}/level_samples.parquet' ORDER BY sample_id").fetchall()
    m = level.LevelModel([t for t, _ in rows], [y for _, y in rows])
    value = np.asarray([m.level(s) for s in m.held_out])
    y = np.asarray([y for _, y in rows])
    assert ((value >= 3.5) == (y >= 4)).mean() > 0.97 and (np.abs(np.floor(value + 0.5) - y) <= 1).mean() > 0.95
    assert (np.diff(m.ys) >= 0).all()


def test_isotonic_equals_brute_force():
    x, y = np.asarray([1.0, 2, 3, 4]), np.asarray([1.0, 3, 2, 4])
    assert np.allclose(np.interp(x, *level.isotonic(x, y)), [1, 2.5, 2.5, 4])


def test_ngram_probabilities_add_up():
    m = level.NGrams([["aba", "ab", "b"]], order=3)
    assert m.surprisal("ab") < m.surprisal("ba") < m.surprisal("zzzz")
    weighted = level.NGrams([["aba"], ["ab"], ["zz"]], order=3, weights=[1.0, 0.5, 0.0])
    assert "zz" not in weighted.words and weighted.surprisal("aba") < weighted.surprisal("ab") < weighted.surprisal("zz")


def test_quantiles():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 40):
        v = rng.normal(size=n)
        assert np.allclose(level.at_quantiles(v, level.QUANTILES), np.quantile(v, level.QUANTILES))


def test_level_edges(spark):
    samples = spark.createDataFrame([("cat sat", 1), ("interdependent normalisation", 5), (None, 3), ("x", None)], "text string, level int")
    model = level.train_level_model(samples)
    df = spark.createDataFrame([*EDGE_TEXTS, (8, "123 !!")], "i int, text string").withColumn("level_words", F.lit("x"))
    got = {r["i"]: r for r in level.reading_levels(df, model).collect()}
    assert got[1]["reading_level"] is None and got[1]["level_words"] == 0 and got[8]["level_words"] == 2 and got[8]["reading_level"] is None and got[6]["level_words"] == 50_000
    assert 1 <= got[4]["reading_level"] <= 5 and got[5]["level_value"] is not None
    assert level.reading_levels(df.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        level.train_level_model(samples.limit(0))


def test_words_without_layout():
    assert level.words_of("<p>[00:00:07] S1: The&nbsp;Hén, 3.5 km</p>") == ["the", "hen", "km"]


