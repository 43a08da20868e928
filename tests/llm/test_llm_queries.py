"""The queries on the smallest tables: against SQL where there is some, else against plain Python."""

import base64
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from clipwright.llm import bpe, clusters, queries, sql
from clipwright.llm.overlap import words_of
from tests.helpers import DATA, rows_of, sql_rows
from tests.llm.test_llm_operators import connected


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_equals_sql(spark, name):
    assert rows_of(queries.QUERIES[name](spark, DATA)) == sql_rows(sql.SQL[name])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_overlaps_equal_all_pairs(spark):
    rows = duckdb.sql(f"SELECT row_id, transcription, split FROM '{DATA}/clips_split.parquet' WHERE transcription IS NOT NULL").fetchall()
    side = lambda *s: [(r, w) for r, t, x in rows if x in s and (w := words_of(t))]
    want = set()
    for r, a in side("train"):
        for q, b in side("validation", "test"):
            most = max(len(a), len(b)) // 8
            if abs(len(a) - len(b)) <= most and sum((Counter(a) & Counter(b)).values()) >= max(len(a), len(b)) - most and edits(a, b) <= most:
                want.add((min(r, q), max(r, q)))
    got = {(r["row_id_a"], r["row_id_b"]) for r in queries.p5_found(spark, DATA).collect()}
    assert want and got == want


def test_report_adds_up(spark):
    rep = queries.p5_report(spark, DATA).collect()
    assert sum(r["rows"] for r in rep) == duckdb.sql(f"SELECT count(*) FROM '{DATA}/clips_split.parquet' WHERE split IN ('validation', 'test')").fetchall()[0][0]
    assert all(r["overlapping"] <= r["rows"] and r["overlapping"] >= max(r["same_id"], r["same_text"], r["near_text"]) for r in rep)


def test_splits_keep_components(spark):
    rows = queries.p1_splits(spark, DATA).collect()
    assert len(rows) == len({r["row_id"] for r in rows})
    by = defaultdict(set)
    for r in rows:
        by[r["component"]].add(r["related_split"])
    assert all(len(s) == 1 for s in by.values())


def test_ids_equal_the_library(spark):
    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())
    got = {r["doc_id"]: r["ids"] for r in queries.p7_ids(spark, DATA).collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in texts.items()}


def test_mixture_keeps_limits_and_shares(spark):
    mix = queries._mixture(spark, DATA)
    shares = {r["source"]: r for r in mix.shares.collect()}
    used = Counter()
    for r in mix.records.collect():
        used[r["source"]] += r["tokens"] * r["copies"]
        assert 1 <= r["copies"] <= shares[r["source"]]["max_repeats"]
    assert {s: r["used_tokens"] for s, r in shares.items() if r["used_tokens"]} == dict(used)
    assert abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-9


def test_stretched_mixture_moves_shortages(spark):
    """Every node's budget is within its capacity, children add up to their parent, and a node gets less than wanted only if it is full."""
    nodes = queries.p8_stretched(spark, DATA).collect()
    path = lambda r: tuple(x for x in (r["domain"], r["language"], r["source"]) if x is not None)
    got = {path(r): r for r in nodes}
    short = 0
    for p, r in got.items():
        kids = [q for q in got if len(q) == len(p) + 1 and q[: len(p)] == p]
        assert r["budget"] <= r["capacity"] + 1e-6 and (not kids or abs(sum(got[q]["budget"] for q in kids) - r["budget"]) < 1e-6)
        if r["budget"] < r["wanted"] - 1e-6:
            short += 1
            assert abs(r["budget"] - r["capacity"]) < 1e-6
    assert short


def test_typical_members(spark):
    sizes = Counter(r["cluster_key"] for r in queries.p6_found(spark, DATA).collect())
    for r in queries.p6_clusters(spark, DATA).collect():
        assert r["size"] == sizes.get(r["cluster_key"], 1) and len(r["typical"]) == min(3, r["size"])


def test_text_clusters_equal_all_pairs(spark):
    features = clusters.hashed_features(queries.table(spark, DATA, "documents").select("doc_id", "text"), "text").select(F.col("doc_id").cast("string").alias("i"), "embedding")
    docs = features.collect()
    x = np.asarray([r["embedding"] for r in docs], np.float64)
    n = np.linalg.norm(x, axis=1)
    names, x = [r["i"] for r, k in zip(docs, n, strict=True) if k > 0], (x[n > 0] / n[n > 0, None]).astype(np.float32)
    want = Counter(connected([(names[i], names[j]) for i, j in zip(*np.nonzero(x @ x.T >= 0.8), strict=True)]).values())
    settings = {"record": "i", "vector": "embedding", "dims": clusters.TEXT_DIMS}
    got = {r["cluster_key"]: r["size"] for r in clusters.describe_clusters(features, clusters.similarity_clusters(features, **settings), **settings).collect()}
    assert got == want and max(got.values()) > 1


def test_all_queries_give_rows(spark):
    for name in ("p2_strata", "p4_found", "p4_canonical", "p8_shares", "p9_found", "p9_levels"):
        assert queries.QUERIES[name](spark, DATA).count() > 0, name
