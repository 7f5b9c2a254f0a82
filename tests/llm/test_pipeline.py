"""The pipeline, stage by stage, against plain versions of what each stage has to do."""

import hashlib

import corpus_pipeline
import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, quality, repeats

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and has returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        out.append((docs, kept))
        docs = kept
    return out


def _texts(df):
    return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]


def test_stages_keep_the_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "repeated strings", "source mixing", "packing"]
    wanted = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    for given, kept in stages[:-1]:
        assert given.dtypes == kept.dtypes == wanted
        assert kept.count() > 0


def test_quality_stage_drops_what_the_classifier_rejects(stages):
    given, kept = stages[0]
    good = {r["doc_id"] for r in quality.score_quality(given).collect() if r["_quality"] >= quality.KEEP}
    assert {i for i, _ in _texts(kept)} == good
    assert 0.7 * given.count() < len(good) < given.count()


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    given, kept = stages[1]
    groups = plain.near_duplicates(_texts(given), 5, 80)
    assert _texts(kept) == [(i, t) for i, t in _texts(given) if groups[i][1] == i]


def test_repeat_stage_removes_later_copies(stages):
    given, kept = stages[2]
    order = sorted(_texts(given))
    want = plain.repeats(order, 200, keep_first=True)
    for (i, before), (j, after) in zip(order, sorted(_texts(kept)), strict=True):
        assert i == j
        data = (before or "").encode()
        # whole characters only: at most the rest of a character at either end of a span stays
        assert 0 <= len((after or "").encode()) - (want[i][0] - want[i][1]) <= 6 * want[i][2]
        if not want[i][1]:
            assert before == after
        assert hashlib.sha256(data).hexdigest() == want[i][3] or len(after) < len(before)
    lengths = {r["doc_id"]: (r["n_chars"], len(r["text"])) for r in kept.collect()}
    assert all(n == m for n, m in lengths.values())


def test_mixing_stage_gives_the_targets(stages):
    given, kept = stages[3]

    def words(df):
        sizes = {}
        for r in df.collect():
            sizes.setdefault(r["source"], []).append(len(plain.WORD.findall((r["text"] or "").encode())))
        return sizes

    before, got = words(given), words(kept)
    targets = plain.targets({s: sum(n) for s, n in before.items()})
    # a source of few documents comes as near as its documents allow
    assert all(abs(sum(got.get(s, [])) - t) <= max(0.02 * t, max(before[s])) for s, t in targets.items())
    copies = kept.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert copies <= 2 and set(_texts(kept)) <= set(_texts(given))


def test_packing_stage_holds_every_document(stages):
    given, packed = stages[4]
    rows = packed.collect()
    assert sorted(r["doc_id"] for r in rows if r["piece"] == 0) == sorted(i for i, _ in _texts(given))
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = corpus_pipeline.run(spark, SF).select(*key).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[4][1].select(*key).collect()))


def test_near_duplicate_stage_keeps_the_named_of_near_copies(spark):
    def text(name, *changed):
        return " ".join("changed" if i in changed else f"{name}{i}" for i in range(100))

    rows = [(None, text("a", 3)), (7, text("a")), (9, text("a", 60)), (None, text("b", *range(0, 100, 9))), (4, text("b")), (None, text("c", 5)), (None, text("c", 5)),
            (8, ""), (8, text("d")), (None, text("d", 1))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCUMENTS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    # without an id: what is no near copy of a named text, once, and documents without words
    want = [(7, text("a")), (None, text("b", *range(0, 100, 9))), (4, text("b")), (None, text("c", 5)), (8, ""), (8, text("d"))]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted((i or 0, t) for i, t in want)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)],
                                  [(i % 3 or None, "the same seven words in every row", None, "a" if i % 2 else None, 33) for i in range(12)]])
def test_stages_take_odd_tables(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k == 1 and len(rows) > 3:
            assert [r["doc_id"] for r in docs.collect()] == [1]
    assert repeats.SPAN == 200


def test_steps_of_a_stage_leave_no_garbage_on_a_full_driver(spark, monkeypatch):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    with common.scratch_scope() as made:
        for share, more in ((2.0, 0), (0.0, 1)):
            monkeypatch.setattr(common, "HEAP_SHARE", share)
            before = whole()
            assert common.saved(spark.range(3), "relieved").count() == 3
            assert whole() - before == more
    for path in made:
        common.remove(spark, path)
