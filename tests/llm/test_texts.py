"""Repeated strings, quality, packing and mixing against plain versions."""

import random
import zlib

import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import mixing, packing, quality, queries, repeats

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _texts():
    r = random.Random(8)
    line = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    shared = [line(n) for n in (60, 90, 300)]
    docs = [line(r.randint(0, 400)) for _ in range(30)]
    for _ in range(40):
        docs.append(line(r.randint(0, 120)) + r.choice(shared) + line(r.randint(0, 120)))
    docs += [docs[3], docs[3], "ab" * 90, "x" * 200, "ab" * 70, shared[2] * 2, None, "", "short", line(49), shared[0][:50]]
    return list(enumerate(docs))


@pytest.mark.parametrize("many", [4096, 2])
def test_repeats_match_all_strings(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)  # 2: also the way for grams with many runs
    monkeypatch.setattr(repeats, "BLOCK", 64)  # texts are cut into many blocks
    monkeypatch.setattr(repeats, "BUCKET", 16)
    monkeypatch.setattr(repeats, "SLICE", 5)
    docs = _texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(0)).withColumn("spans", F.lit("s"))
    for keep_first in (False, True):
        want = plain.repeats(docs, 50, keep_first)
        got = repeats.cut_repeats(df, span=50, keep_first=keep_first).select("id", "n_bytes", "n_removed", F.size("spans").alias("s"), F.sha2("kept", 256).alias("h")).collect()
        assert len(got) == len({x["id"] for x in got})
        assert all(tuple(x)[1:] == want[x["id"]] for x in got)
        assert {i for i, w in want.items() if w[1]} == {x["id"] for x in got if x["n_removed"]}


def test_longest_factors_match_plain_search():
    r = random.Random(2)
    for n, width, letters in ((1, 5, "ab"), (2, 3, "a"), (40, 6, "ab"), (200, 4, "ab"), (120, 30, "a\0"), (300, 8, "abc")):
        text = "".join(r.choices(letters, k=n + width)).encode()
        strings = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), width)[:n]
        position = np.array(r.sample(range(10 * n), n))
        other, previous = repeats.factors(strings, position)

        def common(a, b, text=text, width=width):
            return next((k for k in range(width) if text[a + k] != text[b + k]), width)

        for i in range(n):
            assert other[i] == max([common(i, j) for j in range(n) if j != i], default=0)
            assert previous[i] == max([common(i, j) for j in range(n) if position[j] < position[i]], default=0)


def test_packing_of_very_many_equal_pieces(spark, monkeypatch):
    """Empty texts without an id are one run of ranks, which is cut over many sequences and blocks."""
    monkeypatch.setattr(packing, "CELL", 3)
    many = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").alias("text"))
    others = spark.createDataFrame([(i % 50, "some words " * (i * 7)) for i in range(120)], many.schema)
    rows = packing.pack(many.unionByName(others), TOKENIZER)
    packed = rows.groupBy("sequence_id").agg(F.sum("length").alias("held"), F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("end"),
                                             F.count_distinct("offset").alias("places"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in packed) == rows.count() and sum(r["n"] for r in packed) >= 100_120
    assert all(r["first"] == 0 and r["end"] == r["held"] <= 2048 and r["places"] == r["n"] for r in packed)
    assert len(packed) == -(-sum(r["held"] for r in packed) // 2048)
    empty = rows.where("doc_id IS NULL").agg(F.count("*").alias("n"), F.max("length").alias("most"), F.max("piece").alias("piece")).first()
    assert tuple(empty) == (100_000, 1, 0)


def test_rows_that_repeat_cost_no_more_than_their_number(spark):
    """Many rows without an id and with one text: each of its strings stands elsewhere, in the others."""
    long = "".join(random.Random(5).choices("abcdef ", k=700))
    many = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(long).alias("text"))
    rows = many.unionByName(spark.createDataFrame([(1, "q" + long[:300]), (2, "other text")], many.schema))
    got = repeats.cut_repeats(rows, keep_first=False).select("id", "n_bytes", "n_removed").collect()
    assert {tuple(x) for x in got} == {(repeats.NO_ID, 700, 700), (1, 301, 300)} and len(got) == 2
    first = repeats.cut_repeats(rows).where("n_removed > 0").select("id", "n_removed").collect()
    assert [tuple(x) for x in first] == [(repeats.NO_ID, 300)]


def test_repeats_query_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.op1_suffix_array_dedup(spark, SF).collect()}
    assert got == plain.repeats(docs, 200)


def test_repeats_edge_rows(spark):
    assert repeats.cut_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = "".join(random.Random(1).choices("abcdef ", k=260))
    rows = [(5, long), (5, long), (None, long + "x"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    all_gone = {(r["id"], r["n_removed"]) for r in repeats.cut_repeats(df, keep_first=False).collect()}
    assert all_gone == {(5, 260), (repeats.NO_ID, 260)}
    first = {(r["id"], r["n_removed"]) for r in repeats.cut_repeats(df).collect() if r["n_removed"]}
    assert first == {(repeats.NO_ID, 260)}


def test_whole_characters_are_spared():
    b = np.frombuffer("aéb€c".encode(), np.uint8)
    low, high = repeats.whole_characters(b, np.array([0, 5]), np.array([2, 8]))
    assert (low.tolist(), high.tolist()) == ([0, 7], [1, 8])
    low, high = repeats.whole_characters(b, np.array([1]), np.array([8]))
    assert b[low[0] : high[0]].tobytes().decode() == "éb€c"


def test_pieces_of_a_sorted_stretch():
    strings = np.frombuffer(b"abcabdabcaaa", np.uint8).reshape(4, 3)
    equal, later = repeats.first_of_kind(strings, np.array([9, 1, 4, 2]))
    assert equal.tolist() == [2, 1, 2, 1] and later.tolist() == [True, False, False, False]


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = queries.op5_quality_classifier(spark, folder).join(labels, "doc_id").collect()
    good = [r for r in got if r["quality"] == 1]
    junk = [r for r in got if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.995 * len(good)
    assert sum(not r["kept"] for r in junk) >= 0.97 * len(junk)


def test_weak_labels_match_a_model_row_by_row():
    r = random.Random(9)
    rows = []
    for _ in range(400):
        truth = r.random() < 0.7
        rows.append([quality.NONE if r.random() < 0.4 else quality.GOOD if (r.random() < right) == truth else quality.JUNK for right in (0.95, 0.8, 0.7, 0.9)])
    patterns, index, counts = np.unique(np.array(rows), axis=0, return_inverse=True, return_counts=True)
    assert np.allclose(quality.fit_votes(patterns, counts)[index.ravel()], plain.weak_labels(rows), atol=1e-7)


def test_scores_of_the_table_match_a_plain_scorer(spark):
    """Votes by combination against row by row, features one trigram at a time, the scorer against the exact minimum of its loss."""
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    said = [quality.votes(np.frombuffer((t or "").encode(), np.uint8)) for _, t in docs]
    post = plain.weak_labels(said)
    x = np.stack([plain.trigram_features(t, v) for (_, t), v in zip(docs, said, strict=True)])
    assert np.allclose(x, [quality.features(np.frombuffer((t or "").encode(), np.uint8), v) for (_, t), v in zip(docs, said, strict=True)])
    first = {t: i for i, (_, t) in reversed(list(enumerate(docs)))}  # a text counts once
    once = sorted(first.values())
    weights, bias = plain.logistic(x[once], np.array(post)[once])
    exact = 1 / (1 + np.exp(-(x @ weights + bias)))
    got = {r["doc_id"]: r["_quality"] for r in quality.score_quality(df).collect()}
    scores = np.array([got[i] for i, _ in docs])
    long = np.array([len((t or "").encode()) >= 3 for _, t in docs])
    assert (scores[~long] == 1).all()
    # descent stops near the minimum: the same side of the cut, and scores close to it
    clear = long & (np.abs(exact - quality.KEEP) > 0.1)
    assert clear.sum() > 0.9 * len(docs) and ((scores >= quality.KEEP) == (exact >= quality.KEEP))[clear].all()
    assert np.corrcoef(scores[long], exact[long])[0, 1] > 0.98


def test_rates_match_a_plain_solver(spark):
    r = random.Random(3)
    docs = [(i, " ".join(["w"] * r.choice([0, 1, 5, 40, 300])), r.choice(["a", "b", "c", None])) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = df.select("source", mixing.word_count(F.col("text")).alias("size"))
    sizes = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = mixing.targets(rows.groupBy("source").agg(F.sum("size").alias("words")))
    for x in mixing._balanced(sizes, sources, mixing.MOST).collect():
        own = [len(t.split()) for _, t, s in docs if s == x["source"] and t]
        if not x["full"]:
            assert abs(x["tilt"] - plain.tilt(own, x["target"])) < 1e-5
            got = sum(mixing.MOST * n / (1 + np.exp(-x["tilt"] * n / x["mean"])) for n in own)
            assert abs(got - x["target"]) < 1e-6 * x["target"]


def test_quality_edge_rows(spark):
    assert quality.score_quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, None), (2, ""), (None, "ab"), (3, "### " * 100), (3, "### " * 100), (4, "x" * 5_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("votes", F.lit(1)).withColumn("_quality", F.lit("q"))
    got = quality.score_quality(df).collect()
    assert len(got) == len(rows) and all(0 <= r["_quality"] <= 1 for r in got)
    assert all(r["_quality"] == 1 for r in got if r["doc_id"] in (1, 2, None))


def test_vote_model_finds_the_accurate_labellers():
    r = np.random.default_rng(1)
    truth = r.random(6000) < 0.8
    votes = np.full((6000, 5), quality.NONE)
    for k, accuracy in enumerate((0.95, 0.9, 0.85, 0.8, 0.55)):
        right = r.random(6000) < accuracy
        said = r.random(6000) < 0.9
        votes[said, k] = np.where(truth == right, quality.GOOD, quality.JUNK)[said]
    patterns, index, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post = quality.fit_votes(patterns, counts)[index.ravel()]
    assert ((post > 0.5) == truth).mean() > 0.95


def _check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def _best_fit(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= x), default=None)
        if fit is None:
            gaps.append(capacity - x)
        else:
            gaps.remove(fit)
            gaps.append(fit - x)
    return len(gaps)


def test_packing_of_the_table(spark):
    rows = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), TOKENIZER).collect()
    assert len(_check_packing(rows, 2048)) == _best_fit([r["length"] for r in rows], 2048)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    tokenizer, want = Tokenizer.from_file(TOKENIZER), set()
    for d in docs:
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want |= {(d["doc_id"], k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want


def test_chunks_have_the_ids_of_the_whole(spark):
    texts = ["It's a TEST\u00a0of\tİstanbul ΣΑΣ", "", "e \u0301x <|endoftext|> y<|startoftext|>z", "a\x0b\x0cb\x1cc  d", "文字 😀!! l'été 12 345",
             "One. two, three.. (four). 5, 6., x\u00d7. \u0301. a\u0301, É. ß, don't, they'll. <|ENDOFTEXT|> K. \u212a."]
    whole = Tokenizer.from_file(TOKENIZER)
    got = packing.Encoder(TOKENIZER).encode(texts)
    assert [g.tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_chunks_keep_signs_and_marks_of_the_whole(spark):
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = ["TARİHİ. SERGİ, İ. İ", "W\u030a x T\u0308. K\u0331, Plain WORDS. beside A\u030a"]
    texts += [" ".join(f"{a}{m}. X{m}{a}," for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ<=>") for m in marks]
    texts += [" ".join(f"N{chr(c)}. {chr(c)}, {chr(c)}.{chr(c)}" for c in range(a, a + 64)) for a in range(0xA0, 0x260, 64)]
    whole = Tokenizer.from_file(TOKENIZER)
    got = packing.Encoder(TOKENIZER).encode(texts)
    assert [g.tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_placement_is_best_fit_decreasing():
    r = random.Random(3)
    for capacity in (16, 100):
        lengths = [r.randint(1, capacity) for _ in range(500)]
        counts = {x: lengths.count(x) for x in set(lengths)}
        plan = list(packing.place(counts, capacity))
        assert len({s + k for _, a, b, s, _ in plan for k in range(b - a)}) == _best_fit(lengths, capacity)
        assert sum(b - a for _, a, b, _, _ in plan) == len(lengths)


def test_packing_edge_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).count() == 0
    rows = [(1, None), (1, None), (None, ""), (2, "word " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("r")).withColumn("length", F.lit(1))
    got = packing.pack(df, TOKENIZER).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in got) == [(0, 0, 1), (1, 0, 1), (1, 0, 1), (2, 0, 2048), (2, 1, 2048), (2, 2, 905)]
    assert len(_check_packing(got, 2048)) == 3


def test_targets_are_the_repeated_sharing(spark):
    r = random.Random(6)
    for _ in range(3):
        sizes = {f"s{i}": r.choice([0, 1, 10, 500, 4000]) for i in range(9)} | {None: 77}
        df = spark.createDataFrame(list(sizes.items()), "source string, words long")
        got = {x["source"]: x["target"] for x in mixing.targets(df).collect()}
        assert got == pytest.approx(plain.targets(sizes))


def test_mix_comes_near_the_targets(spark):
    rows = queries.op10_mix_sources(spark, "/root/testdata/sf0.01").collect()
    again = queries.op10_mix_sources(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    docs = {x["doc_id"]: x for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text").collect()}
    size, taken, target = {}, {}, {}
    for x in rows:
        d = docs[x["doc_id"]]
        assert x["size"] == len(plain.WORD.findall((d["text"] or "").encode())) and 0 <= x["taken"] <= 2 * x["size"]
        assert x["size"] == 0 or x["taken"] % x["size"] == 0
        size[d["source"]] = size.get(d["source"], 0) + x["size"]
        taken[d["source"]] = taken.get(d["source"], 0) + x["taken"]
        target[d["source"]] = x["target"]
    assert target == pytest.approx(plain.targets(size))
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in size)


def test_mix_gives_copies_to_as_many_repeats_as_fit(spark):
    schema = "doc_id long, text string, source string, lang string"
    rows = [(i, "long " * 400, s, "en") for s in "abc" for i in range(30)]
    rows += [(1000 + i % 5 or None, "five words to a row", s, f"l{i % 2}") for s in "abc" for i in range(5000)]
    rows += [(None, "three words here", s, None) for s in "abc" for _ in range(5000)]
    df = spark.createDataFrame(rows, schema)
    got = mixing.mix(df, carry=["doc_id", "source", "lang"]).collect()
    assert len(got) == len(rows)
    for s in "abc":
        mine = [x for x in got if x["source"] == s]
        assert 0 <= mine[0]["_target"] - sum(x["_copies"] * x["_size"] for x in mine) < 405, s
    again = mixing.mix(df.repartition(7), carry=["doc_id", "source", "lang"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mix_does_not_overshoot_by_repeats(spark):
    rows = [(i, "long " * 97, s) for s in "abcdefg" for i in range(300)]
    rows += [(None, f"three words {k}", s) for s in "abcdefg" for k in range(40) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, weights=(1, 1.1, 1.2, 1.3, 1.15, 1.05, 1.07), carry=["doc_id", "source"]).collect()
    for s in "abcdefg":
        mine = [x for x in got if x["source"] == s]
        assert 0 <= mine[0]["_target"] - sum(x["_copies"] * x["_size"] for x in mine) < 97, s


def test_mix_edge_rows(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, "a"), (2, "", "b"), (None, "x y z", None), (3, "x y", "a"), (3, "x y", "a"), (4, " ".join("w" * 300_000), "c")]
    df = spark.createDataFrame(rows, schema).withColumn("size", F.lit("s")).withColumn("target", F.lit(1))
    got = mixing.mix(df, carry=["doc_id", "size", "source"]).collect()
    assert len(got) == len(rows)
    assert {x["_copies"] for x in got} <= {0, 1, 2} and all(x["_copies"] == 0 for x in got if x["_size"] == 0)
    nothing = mixing.mix(spark.createDataFrame([(1, None, None)], schema)).collect()
    assert [(x["_size"], x["_copies"], x["_target"]) for x in nothing] == [(0, 0, 0.0)]
