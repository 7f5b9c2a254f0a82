"""Near-duplicate texts and vectors, components and exact search against plain versions."""

import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from millrace.llm import components, near_dup, topk, vectors

SF = "/root/testdata/sf0.001"


def _texts(seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(40):
        base = r.choices(words, k=r.choice([5, 12, 40, 200]))
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            docs.append(" ".join(copy))
    docs += ["", None, " \t\n", "one", "One", "a b c", "a  b\nc", "a b c d"]
    return list(enumerate(docs))


def _found(docs_df, **options):
    rows = near_dup.near_duplicates(docs_df, **options).collect()
    return {r["doc_id"]: (r["_n"], r["_component"]) for r in rows}, len(rows)


@pytest.mark.parametrize("small", [256, 3])
def test_near_duplicates_match_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(near_dup, "SMALL_GROUP", small)  # 3: also the way for large groups
    monkeypatch.setattr(near_dup, "CHUNK", 4)
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    docs = _texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("_component", F.lit(0))
    got, n = _found(df, shingle=4)
    assert n == len(docs)
    assert got == plain.near_duplicates(docs, 4, 80)


def test_near_duplicates_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    for size in (4, 5):
        assert _found(df, shingle=size)[0] == plain.near_duplicates(docs, size, 80)


def test_near_duplicates_edge_rows(spark):
    schema = "doc_id long, text string"
    assert near_dup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (9, None), (None, "lone words here")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] or -1, r["_n"], r["_component"] or -1) for r in got) == sorted([(-1, 2, 7), (7, 2, 7), (7, 2, 7), (-1, 0, -1), (9, 0, 9), (-1, 1, -1)])


def test_registers_of_equal_parts_agree():
    r = np.random.default_rng(5)
    a = np.unique(r.integers(0, 2**63, 3000).astype(np.uint64))
    b = np.unique(np.r_[a[:2700], r.integers(0, 2**63, 300).astype(np.uint64)])
    regs = near_dup.registers([a, b])
    guess, error = near_dup.estimate(regs[1:], regs[0], np.array([len(b)]), len(a))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(guess[0] - true) < 4 * error[0]


def test_components_of_chain_star_and_copies(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    joined = plain.Sets()
    for a, b in edges:
        joined.join(a, b)
    by_root = {}
    for r in got:
        by_root.setdefault(r["root"], set()).add(joined.find(r["node"]))
    assert all(len(v) == 1 for v in by_root.values()) and len(by_root) == 3
    assert len(got) == 61 + 50 + 2
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1024, 8])
def test_near_vectors_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)  # 8: filters are split over many tasks
    r = np.random.default_rng(11)
    rows = []
    for _ in range(60):
        base = r.standard_normal(24)
        rows += [(base + 0.35 * r.random() * r.standard_normal(24)).tolist() for _ in range(r.integers(1, 7))]
    rows += [rows[0], [2 * x for x in rows[0]], None, [0.0] * 24, [], [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [-0.0, 1.0], [0.0, 2.0]]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("links", F.lit(1))
    got = {x["vec_id"]: (x["_links"], x["_component"]) for x in vectors.near_vectors(df).collect()}
    flat = plain.near_vectors(rows[:-2], 0.9)
    flat[rows[-2][0]] = flat[rows[-1][0]] = (1, rows[-2][0])
    assert got == flat


def test_near_vectors_edge_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.1])], schema)
    assert sorted(tuple(x) for x in vectors.near_vectors(df).collect()) == [(1, 1, 1), (3, 1, 1)]


def test_near_vectors_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(x["vec_id"], x["embedding"]) for x in df.select("vec_id", "embedding").collect()]
    want = plain.near_vectors(rows, 0.9)
    got = {x["vec_id"]: (x["_links"], x["_component"]) for x in vectors.near_vectors(df).collect()}
    assert sum(x[0] for x in got.values()) >= 0.99 * sum(x[0] for x in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_filters_meet_near_pairs():
    r = np.random.default_rng(2)
    n = 4000
    a = r.standard_normal((n, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = r.standard_normal((n, 64))
    away -= (away * a).sum(axis=1, keepdims=True) * a
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * away
    for count in (500, 50_000):
        f = vectors.Filters(64, count, 0.9)
        sets = []
        for x in (a, b):
            row, filt = f.passed(x)
            sets.append(set(zip(row.tolist(), filt.tolist(), strict=True)))
        met = {row for row, _ in sets[0] & sets[1]}
        assert len(met) >= 0.999 * n


@pytest.mark.parametrize("dim, count", [(64, 10**6), (64, 10**7), (64, 10**8), (2, 10**5), (8, 10**5), (17, 10**6)])
def test_filters_meet_near_pairs_of_large_tables(dim, count):
    r = np.random.default_rng(3)
    n = 2000
    a = r.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = r.standard_normal((n, dim))
    away -= (away * a).sum(axis=1, keepdims=True) * a
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * away
    f = vectors.Filters(dim, count, 0.9)
    assert len(f.codes) == round(np.log2(count))
    met, shared = set(), 0
    for at in range(0, n, 200):
        sets = []
        for x in (a, b):
            row, filt = f.passed(x[at : at + 200])
            sets.append(set(zip(row.tolist(), filt.tolist(), strict=True)))
        shared += len(sets[0] & sets[1])
        met |= {at + row for row, _ in sets[0] & sets[1]}
    assert len(met) >= 0.999 * n
    assert shared / n >= 0.95 * 2 * np.log2(count)


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 40)])
def test_top_k_matches_full_sort(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "ROW_BLOCK", blocks[1])
    r = np.random.default_rng(4)
    rows = [(i, r.integers(-3, 4, 8).astype(float).tolist()) for i in range(-20, 180)]
    rows += [(i, [1.0] * 8) for i in range(200, 260)]  # many equal scores
    rows += [(300, None), (301, [float("inf")] * 8), (302, [None] * 8), (320, [0.5, 0.25]), (340, [0.1, 4000.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in topk.exact_top_k(df, k=7).collect()}
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == plain.top_k(exact, 7, 20)


def test_top_k_edge_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.exact_top_k(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(20, [1.0]), (20, [1.0]), (21, [0.5])], schema)
    assert [tuple(x) for x in topk.exact_top_k(df).collect()] == [(20, 1, 21, 2048)]
