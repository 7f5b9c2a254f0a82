"""Clusters by bit planes, FM-index decontamination and the filter audit against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import audit, clusters, contamination, fm_index, queries, term_matrix

SF = "/root/testdata/sf0.001"
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# --- clusters ------------------------------------------------------------------------------


def _plain_clusters(rows, k=16, rounds=3):
    """(id, integers) → (cluster, distance) by row, centroids."""
    named = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(q) for _, q in named[:k]]

    def assign():
        out = []
        for _, q in rows:
            d = [sum((a - b) ** 2 for a, b in zip(q, c, strict=True)) for c in cents]
            best = min(range(len(cents)), key=lambda j: (d[j], j))
            out.append((best, d[best]))
        return out

    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            own = [q for (_, q), (c, _) in zip(rows, got, strict=True) if c == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return assign(), cents


def _check_clusters(got, rows, **options):
    want, cents = _plain_clusters(rows, **options)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    inertia = Counter()
    for c, d in want:
        inertia[c] += d
    expected = Counter((i, c, d, inertia[c], sum(inertia.values()), digests[c]) for (i, _), (c, d) in zip(rows, want, strict=True))
    assert Counter((r["vec_id"], r["_cluster"], r["_distance"], r["_cluster_inertia"], r["_inertia"], r["_centroid_sha256"]) for r in got) == expected
    assert all(hashlib.sha256(",".join(map(str, r["_centroid"])).encode()).hexdigest() == r["_centroid_sha256"] for r in got)


def test_bit_planes_give_exact_distances():
    rng = np.random.default_rng(5)
    for high in (1, 63, 64, 65, 1000, 2**25):
        v, c = rng.integers(-high, high + 1, (50, 64)), rng.integers(-high, high + 1, (5, 64))
        bits = clusters.bits_for(min(v.min(), c.min()), max(v.max(), c.max()))
        want = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert (clusters.distances(clusters.planes_of(v, bits), clusters.planes_of(c, bits), bits) == want).all()
        near = want.argmin(axis=1)
        count, total = clusters.sums(clusters.planes_of(v, bits), near, 5, bits)
        assert (count == np.bincount(near, minlength=5)).all()
        assert (total == np.stack([v[near == j].sum(axis=0) for j in range(5)])).all()
    assert clusters.bits_for(-64, 64) == 8 and clusters.bits_for(-64, 63) == 7 and clusters.bits_for(0, 0) == 1


def test_clusters_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], [math.floor(64 * x) for x in r["embedding"]]) for r in df.collect()]
    _check_clusters(clusters.centroid_clusters(df).collect(), rows)


def test_clusters_edge_rows(spark):
    rng = random.Random(2)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(64)]
    same = vector()
    rows = [(i, vector()) for i in range(12)] + [(3, vector()), (3, same), (3, same), (None, same), (None, vector())]
    rows += [(40 + i, same) for i in range(30)]  # ties everywhere, empty clusters stay
    bad = [(90, None), (91, same[:63]), (92, same + [0.5]), (93, [None] + same[1:]), (94, [float("nan")] + same[1:]), (95, [float("inf")] + same[1:]), (96, [])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(rows + bad, schema).withColumns({"_cluster": F.lit(1), "_q": F.lit("x"), "_id": F.lit(2), "cluster": F.lit(3)})
    plain_rows = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    _check_clusters(clusters.centroid_clusters(df).collect(), plain_rows)
    _check_clusters(clusters.centroid_clusters(df.limit(0).unionByName(df.where("vec_id IN (0, 1)"))).collect(), plain_rows[:2])
    assert clusters.centroid_clusters(spark.createDataFrame(bad, schema)).collect() == []
    with pytest.raises(ValueError):
        clusters.centroid_clusters(spark.createDataFrame([(1, [1e300] * 64)], schema))


# --- decontamination -----------------------------------------------------------------------


def _words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(UPPER))


def _plain_contamination(docs, items, window=10):
    """[(id, words, hit places, item texts' ids)]"""
    held = defaultdict(set)
    for item, text in items:
        w = _words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if w else ():
            held[tuple(w[i : i + size])].add(item if item is not None else ("text", text))
    out = []
    for i, text in docs:
        w = _words(text)
        hit, found = set(), set()
        for size in {len(p) for p in held}:
            for at in range(len(w) - size + 1):
                who = held.get(tuple(w[at : at + size]))
                if who:
                    hit |= set(range(at, at + size))
                    found |= who
        out.append((i, len(w), frozenset(hit), frozenset(found)))
    return out


def _check_contamination(got, docs, items, **options):
    want = Counter((i, n, hit, len(found), ",".join(sorted(str(x) for x in found if not isinstance(x, tuple)))) for i, n, hit, found in _plain_contamination(docs, items, **options))
    places = lambda spans: frozenset(p for s in spans for p in range(s["low"], s["high"]))
    assert Counter((r["doc_id"], r["_n_words"], places(r["_spans"]), r["_n_items"], ",".join(r["_items"])) for r in got) == want
    assert all(r["_n_hit"] == len(places(r["_spans"])) for r in got)
    assert all(a["high"] < b["low"] for r in got for a, b in zip(r["_spans"], r["_spans"][1:], strict=False))


def test_index_finds_all_phrases():
    rng = np.random.default_rng(4)
    for texts, vocabulary in ((1, 3), (7, 2), (30, 5), (40, 1000), (5, 1)):
        words = rng.integers(0, 2**63, vocabulary).astype(np.uint64)
        counts = rng.integers(0, 60, texts)
        hashes = words[rng.integers(0, vocabulary, counts.sum())]
        if texts == 30:  # a copy beside its original
            counts[1] = counts[0]
            hashes = np.concatenate([hashes[: counts[0]], hashes[: counts[0]], words[rng.integers(0, vocabulary, counts[2:].sum())]])
        parts = fm_index.build(hashes, counts)
        parts = {name: np.frombuffer(parts[name].astype(kind).tobytes(), kind) for name, kind in contamination._PARTS.items()}
        index = fm_index.Index(parts, len(hashes) + texts)
        symbol = np.searchsorted(index.words, hashes) + 1
        starts = np.cumsum(counts + 1) - counts - 1
        cuts = np.r_[0, np.cumsum(counts)]
        phrases = {tuple(symbol[a : a + n].tolist()) for t in range(texts) for n in (1, 2, 4, 9) for a in range(cuts[t], cuts[t + 1] - n + 1)}
        phrases |= {tuple(rng.integers(1, len(index.words) + 1, 3).tolist()) for _ in range(20)}
        phrases = sorted(phrases) or [(1,)]
        table, lengths = np.zeros((len(phrases), 9), np.int64), np.array([len(p) for p in phrases])
        for r, p in enumerate(phrases):
            table[r, : len(p)] = p
        which, low, high = index.search(table, lengths)
        got = {phrases[w]: sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high, strict=True)}
        want = defaultdict(list)
        for t in range(texts):
            text = symbol[cuts[t] : cuts[t + 1]].tolist()
            for p in phrases:
                want[p] += [int(starts[t]) + a for a in range(len(text) - len(p) + 1) if tuple(text[a : a + len(p)]) == p]
        assert got == {p: sorted(v) for p, v in want.items() if v}


@pytest.mark.parametrize("small", [False, True])
def test_contamination_matches_plain_search(spark, monkeypatch, small):
    if small:  # many shards and blocks, long texts in parts, hits located in slices; workers get the values by the modules' pickled functions
        monkeypatch.setattr(contamination, "PHRASES", 5)
    r = random.Random(6)
    pool = [f"w{i}" for i in range(30)] + ["Été", "ß9", "中文"]
    line = lambda n: r.choice([" ", ", ", "\n"]).join(r.choices(pool, k=n))
    items = [(i, line(r.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(3, items[5][1]), (None, line(14)), (None, items[5][1]), (77, items[5][1]), (78, ""), (79, None), (80, " .,; "), (81, "w3"), (82, "W3!")]
    docs = []
    for i in range(60):
        parts = [line(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            passage = r.choice(items)[1] or ""
            parts += [passage.upper() if r.random() < 0.3 else passage, line(r.randint(0, 20))]
        docs.append((i, " ".join(parts)))
    docs += [(5, docs[5][1]), (None, docs[5][1]), (None, None), (101, ""), (102, "?!"), (103, items[0][1] + items[0][1]), (104, "w3 W3 w3")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit(1), "docs": F.lit("x"), "_n_hit": F.lit(2), "phrase": F.lit(3)})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit(1), "words": F.lit(0)})
    _check_contamination(contamination.find_contamination(df, bench).collect(), docs, items)


def test_contamination_in_small_shards_and_long_texts(spark, monkeypatch):
    """Texts longer than a block make several texts of the shard that overlap."""
    r = random.Random(7)
    items = [(i, " ".join(r.choices("abcdefgh", k=14))) for i in range(3)]
    docs = [(i, " ".join(r.choices("abcdefgh", k=900)) + " " + items[i % 3][1] + " x " + items[0][1][:21]) for i in range(6)]
    docs += [(9, "longword" * 40 + " " + items[1][1])]
    texts = pa.array([t for _, t in docs])
    from millrace.llm import words

    monkeypatch.setattr(words, "BLOCK", 100)
    monkeypatch.setattr(contamination, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    rows = list(contamination._shards(10, 200)([pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), texts], ["id", "text"])]))
    assert len(rows) > 10
    windows = list(contamination._windows(10)([pa.RecordBatch.from_arrays([pa.array([i for i, _ in items]), pa.array([t for _, t in items])], ["item_text", "text"])]))
    phrases = {p: w for b in windows for p, w in zip(b.column("phrase").to_pylist(), b.column("words").to_pylist(), strict=True)}
    every = np.array(list(phrases.values()), np.int64).view(np.uint64)
    known, place = np.unique(every, return_inverse=True)
    run = contamination._search(known, place.reshape(every.shape), np.full(len(every), 10), np.array(list(phrases)))
    hit = defaultdict(set)
    for b in run(rows):
        for doc, spans in zip(b.column("doc").to_pylist(), b.column("spans").to_pylist(), strict=True):
            hit[doc] |= {p for s in spans for p in range(s["low"], s["high"])}
    want = {i: h for i, (_, _, h, _) in enumerate(_plain_contamination(docs, items)) if h}
    assert {k: frozenset(v) for k, v in hit.items()} == want
    fresh = Counter()
    for b in rows:
        fresh.update(dict.fromkeys(b.column("docs")[0].as_py(), 0))
        for doc, n in zip(b.column("docs")[0].as_py(), b.column("fresh")[0].as_py(), strict=True):
            fresh[doc] += n
    assert [fresh[i] for i in range(len(docs))] == [len(_words(t)) for _, t in docs]


def test_contamination_of_empty_tables(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    none = contamination.find_contamination(spark.createDataFrame([], docs), spark.createDataFrame([(1, "a b")], items))
    assert none.collect() == []
    clean = contamination.find_contamination(spark.createDataFrame([(1, "a b")], docs), spark.createDataFrame([], items)).collect()
    assert [(r["doc_id"], r["_n_words"], r["_n_hit"], r["_n_items"], r["_items"], r["_spans"]) for r in clean] == [(1, 2, 0, 0, [], [])]


# --- audit ---------------------------------------------------------------------------------


def _failures(docs):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        out.append((part or "", i, f + "D" * bool(re.search("[#$%&*|]", t)) + "E" * (i is not None and i > first[t])))
    return out


def _plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for part, i, f in _failures(docs):
        parts[part].append((i, f))
    out, shapley = {}, Counter()
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                past = set(order[: step - 1])
                gone = [bool(past & set(f)) for _, f in rows]
                here = [i for (i, f), g in zip(rows, gone, strict=True) if x in f and not g]
                shapley[part, x] += len(here)
                out[part, order, step] = [
                    sum(not g and x not in f for (_, f), g in zip(rows, gone, strict=True)), len(here),
                    sum(g and x in f for (_, f), g in zip(rows, gone, strict=True)), sum(f == x for _, f in rows),
                    sum(i in good for i in here), sum(i in toxic for i in here),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _audited(rows):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(got) == len(rows)
    return got


def test_audit_of_the_table(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert _audited(queries.op13_filter_interaction_audit(spark, SF).collect()) == _plain_audit(docs, labels)


def test_audit_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(250))
    few = " ".join(["a", "b"] * 150)
    docs = [(1, long, "s"), (2, long, "t"), (2, long, "t"), (1, long, "s"), (None, long, None), (None, long, ""), (3, None, None), (4, "", "s"), (5, few, "s")]
    docs += [(6, few + " #", "s"), (7, long.upper(), "s"), (8, " \t\n" + long + "\x0b", "t"), (9, "ÉÀ" * 300, "t"), (5, "other", "s"), (10, "x" * 3000, "t")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (5, 1, None), (99, 1, 1), (3, 0, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"part": F.lit(1), "mask": F.lit(2), "n": F.lit(3), "words": F.lit(0)})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(5))
    assert _audited(audit.filter_interactions(df, marks).collect()) == _plain_audit(docs, labels)
    assert _audited(audit.filter_interactions(df, marks.limit(0)).collect()) == _plain_audit(docs, [])
    assert audit.filter_interactions(df.limit(0), marks).collect() == []


def test_term_matrix_counts_words(spark, monkeypatch):
    docs = [(i, r["text"]) for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect())] + [(40, None), (41, "")]
    matrix, dictionary = term_matrix.term_matrix(spark.createDataFrame(docs, "n long, text string"), {"n": F.col("n")})
    names = {r["term"]: r["word"] for r in dictionary.collect()}
    assert len(set(names.values())) == len(names)
    got = {}
    for r in matrix.collect():
        ends, terms, counts = np.frombuffer(r["ends"], "<i8"), np.frombuffer(r["terms"], "<i8"), np.frombuffer(r["counts"], "<u4")
        for k, n in enumerate(r["n"]):
            got[n] = Counter({names[t]: c for t, c in zip(terms[ends[k] : ends[k + 1]].tolist(), counts[ends[k] : ends[k + 1]].tolist(), strict=True)})
    assert got == {n: Counter(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for n, t in docs}


def test_term_matrix_cuts_long_texts(monkeypatch):
    monkeypatch.setattr(term_matrix, "PIECE", 50)
    monkeypatch.setattr(term_matrix, "SHARD", 400)
    monkeypatch.setattr(term_matrix, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    r = random.Random(1)
    texts = [" ".join(r.choices(["a", "bb", "éé", "w" * 90, "中"], k=r.choice([0, 3, 40, 200]))) for _ in range(30)] + [None, "\n\n", "q" * 300]
    got = []
    shards = list(term_matrix._shards(1)([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["n", "text"])]))
    assert len(shards) > 3
    for b in shards:
        ends = np.frombuffer(b.column("ends")[0].as_py(), "<i8")
        columns, counts = term_matrix._columns(term_matrix._wide(b.column("columns")[0].as_py()), ends), term_matrix._wide(b.column("counts")[0].as_py())
        words = b.column("words")[0].as_py()
        for k in range(len(ends) - 1):
            got.append(Counter({words[c]: int(n) for c, n in zip(columns[ends[k] : ends[k + 1]], counts[ends[k] : ends[k + 1]], strict=True)}))
    assert got == [Counter(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
