"""Benchmark decontamination: an FM-index for each shard of the corpus, searched for test phrases.

1. The documents of each task are gathered into shards of about a million words, and each shard's
   FM-index (see ``fm_index``) is written, one row a shard. A document longer than a block of
   text makes several texts that overlap by a phrase's length less one word, so no task holds
   more than a shard's arrays. Documents are never shuffled.
2. Test items make windows of words; equal windows are one phrase. Phrases are searched in
   blocks of a fixed size, each block in all shards: the words from the right, by ranks in the
   shard's wavelet matrix. What occurs is located by sampled positions.
3. A document's stretches, of all its texts and all blocks, are merged. The items of documents
   are looked up once for each distinct set of phrases, so a passage that many documents or
   items share is looked up once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import fm_index
from millrace.llm.common import saved, scalar, trimmed
from millrace.llm.repeats import merged
from millrace.llm.words import PUNCTUATION, mix, word_blocks

WINDOW = 10
SHARD = 1 << 20  # words of a shard, about: a shard closes when the next block would pass it
PHRASES = 1 << 16  # phrases searched at once: 6 MB at most for windows of 10 words
HITS = 1 << 20  # occurrences located at once
_PARTS = {"words": "<u8", "starts": "<i4", "planes": "<u8", "zeros": "<i8", "delta": "<i4", "marks": "<u8", "samples": "<i4"}
_HITS = "doc long, spans array<struct<low: long, high: long>>, phrases array<long>"


def _lists(parts: list, kind: pa.DataType) -> pa.Array:
    """A list column of one row."""
    values = pa.concat_arrays([p.cast(kind) for p in parts])
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _shards(window: int, shard: int):
    """One row for each shard: its texts' documents, ids, first words and numbers of new words, and the index."""

    def run(batches):
        prefix, row = TaskContext.get().partitionId() << 40, 0
        kept, size = [], 0
        for batch in batches:
            ids = batch.column("id")
            long, tail, base = -1, np.zeros(0, np.uint64), 0
            for at, h, counts in word_blocks(batch.column("text"), PUNCTUATION):
                if kept and size + len(h) > shard:
                    yield _indexed(kept, ids.type)
                    kept, size = [], 0
                docs = prefix + row + at + np.arange(len(counts))
                again = long == at  # the next part of a long text
                if not again:
                    tail, base = np.zeros(0, np.uint64), 0
                fresh = counts.astype(np.int64)
                whole = np.r_[tail, h] if len(tail) else h
                kept.append((docs, ids.slice(at, len(counts)), np.full(len(counts), base), fresh, whole, counts + len(tail)))
                size += len(whole)
                base += len(whole) - min(len(whole), window - 1)
                long, tail = (at if len(counts) == 1 else -1), whole[len(whole) - min(len(whole), window - 1) :]
            row += batch.num_rows
        if kept:
            yield _indexed(kept, ids.type)

    def _indexed(kept: list, id_type: pa.DataType) -> pa.RecordBatch:
        docs, ids, base, fresh, hashes, counts = zip(*kept, strict=True)
        parts = fm_index.build(np.concatenate(hashes), np.concatenate(counts))
        size = sum(len(h) for h in hashes) + sum(len(c) for c in counts)
        numbers = [_lists([pa.array(x) for x in column], pa.int64()) for column in (docs, base, fresh)]
        binary = [pa.array([parts[name].astype(kind).tobytes()], pa.binary()) for name, kind in _PARTS.items()]
        return pa.RecordBatch.from_arrays([_lists(list(ids), id_type), *numbers, pa.array([size]), *binary], ["ids", "docs", "base", "fresh", "n", *_PARTS])

    return run


def build_index(docs: DataFrame, window: int = WINDOW, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: one row for each shard of about ``shard`` words, for phrases of at most ``window`` words."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"ids array<{kind}>, docs array<long>, base array<long>, fresh array<long>, n long, " + ", ".join(f"{name} binary" for name in _PARTS)
    return saved(rows.mapInArrow(trimmed(_shards(window, shard)), schema), "contamination-index")


def _windows(window: int):
    """Windows of each text: the text's number, the window's own hash and its words' hashes."""

    def run(batches):
        for batch in batches:
            texts = {}
            for at, h, counts in word_blocks(batch.column("text"), PUNCTUATION):
                ends = np.cumsum(counts)
                for r, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
                    texts.setdefault(at + r, []).append(h[end - n : end])
            for r, parts in texts.items():
                h = np.concatenate(parts)
                size = min(window, len(h))
                if not size:
                    continue
                rows = np.lib.stride_tricks.sliding_window_view(h, size)
                key = np.full(len(rows), size, np.uint64)
                for j in range(size):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
                key, first = np.unique(key, return_index=True)
                for some in range(0, len(key), 10_000):
                    part = rows[first[some : some + 10_000]]
                    ends = pa.array(np.arange(0, part.size + 1, size, dtype=np.int32))
                    words = pa.ListArray.from_arrays(ends, pa.array(part.ravel().view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("item_text").take(pa.array(np.full(len(part), r))), pa.array(key[some : some + 10_000].view(np.int64)), words],
                        ["item_text", "phrase", "words"],
                    )

    return run


def _search(words: np.ndarray, place: np.ndarray, lengths: np.ndarray, names: np.ndarray):
    """Occurrences, in each shard, of phrases whose words are ``words[place]``."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r] for name in batch.schema.names}
                index = fm_index.Index({name: np.frombuffer(row[name].as_buffer(), kind) for name, kind in _PARTS.items()}, row["n"].as_py())
                known = np.searchsorted(index.words, words)
                found = np.r_[index.words, np.uint64(0)][known] == words
                found[known == len(index.words)] = False
                symbols = np.where(found, known + 1, 0)[place]
                usable = (symbols > 0) | (np.arange(place.shape[1]) >= lengths[:, None])
                which, low, high = index.search(symbols, np.where(usable.all(axis=1), lengths, 0))
                docs, base = (row[name].values.to_numpy() for name in ("docs", "base"))
                hits, total, some = [], high - low, 0
                while some < len(which):
                    last = max(some + 1, int(np.searchsorted(np.cumsum(total[some:]), HITS, "right")) + some)
                    n = total[some:last]
                    phrase = np.repeat(which[some:last], n)
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some:last], n)
                    position = index.locate(at)
                    text = np.searchsorted(index.starts, position, "right") - 1
                    first = position - index.starts[text] + base[text]
                    hits.append(_by_text(text, first, first + lengths[phrase], names[phrase]))
                    some = last
                if hits:
                    yield _rows([np.concatenate(x) for x in zip(*hits, strict=True)], docs)

    def _by_text(text, low, high, phrase):
        """Hits as (text, low, high, phrase), with the stretches of each text merged: phrases stand beside empty stretches."""
        far = int(high.max()) + 2
        starts, ends = merged(text * far + low, text * far + high)
        pairs = np.unique(np.c_[text, phrase], axis=0)
        none = np.full(len(pairs), -1)
        return np.r_[starts // far, pairs[:, 0]], np.r_[starts % far, none], np.r_[ends - starts // far * far, none], np.r_[np.zeros(len(starts), np.int64), pairs[:, 1]]

    def _rows(hits, docs):
        text, low, high, phrase = hits
        texts = np.unique(text)
        span = low >= 0

        def lists(mask, *columns):
            order = np.flatnonzero(mask)[np.argsort(text[mask], kind="stable")]
            ends = np.r_[0, np.searchsorted(text[order], texts, "right")].astype(np.int32)
            return pa.array(ends), [pa.array(c[order]) for c in columns]

        ends, (starts, stops) = lists(span, low, high)
        spans = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([starts, stops], ["low", "high"]))
        ends, (names_,) = lists(~span, phrase)
        return pa.RecordBatch.from_arrays([pa.array(docs[texts]), spans, pa.ListArray.from_arrays(ends, names_)], ["doc", "spans", "phrases"])

    return run


def _merge_spans(batches):
    """The stretches of each document, merged, their words, and its phrases once each."""
    for batch in batches:
        spans, phrases = [], []
        for r in range(batch.num_rows):
            some = batch.column("spans")[r].values
            low, high = merged(*(some.field(name).to_numpy(zero_copy_only=False) for name in ("low", "high")))
            spans.append((low, high))
            phrases.append(np.unique(batch.column("phrases")[r].values.to_numpy(zero_copy_only=False)))
        ends = [np.r_[0, np.cumsum([len(x) for x in column])].astype(np.int32) for column in ([s[0] for s in spans], phrases)]
        low, high, names = (np.concatenate([np.zeros(0, np.int64), *x]) for x in ([s[0] for s in spans], [s[1] for s in spans], phrases))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.ListArray.from_arrays(pa.array(ends[0]), pa.StructArray.from_arrays([pa.array(low), pa.array(high)], ["low", "high"])),
                pa.array([int((h - x).sum()) for x, h in spans], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends[1]), pa.array(names)),
            ],
            ["doc", "spans", "n_hit", "phrases"],
        )


def _search_block(index: DataFrame, block: list) -> DataFrame:
    lengths = np.array([len(r["words"]) for r in block], np.int64)
    every = np.zeros((len(block), int(lengths.max())), np.int64)
    for r, row in enumerate(block):
        every[r, : lengths[r]] = row["words"]
    words, place = np.unique(every.view(np.uint64), return_inverse=True)
    names = np.array([r["phrase"] for r in block], np.int64)
    run = _search(words, place.reshape(every.shape).astype(np.int32), lengths, names)
    return index.drop("ids", "fresh").mapInArrow(trimmed(run), _HITS)


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row for each document: the id, _n_words, _n_hit, _spans, _n_items, _items.

    Words are runs of digits, letters and all non-ASCII characters, A-Z lower-cased. A phrase is
    ``window`` words of an item that follow each other, or all words of a shorter item. _spans
    are the maximal stretches of words that lie in a phrase, [low, high) from 0, and _n_hit
    their words; _items are the ids, as sorted strings, of the items of which a phrase occurs,
    _n_items their number. NULL and empty texts have no words, items without words no phrase.
    Rows that repeat, ids that repeat and NULL ids are documents of their own; items that repeat
    an id count once, and each text of items without an id once, though without a name in
    _items. No documents: no rows; no items: no hits. Other columns do not matter.
    """
    index = build_index(docs, window, id_col=id_col, text_col=text_col)
    texts = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    texts = texts.withColumn("item_text", F.xxhash64("text"))
    named = texts.select("item_text", "item").distinct()
    windows = texts.select("item_text", "text").dropDuplicates(["item_text"]).mapInArrow(_windows(window), "item_text long, phrase long, words array<long>")
    windows = saved(windows, "contamination-windows")
    blocks = max(1, -(-scalar(windows.agg(F.count_distinct("phrase"))) // PHRASES))
    phrases = windows.select("phrase", "words").dropDuplicates(["phrase"]).withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks)))
    phrases = saved(phrases, "contamination-phrases")

    found = None
    for k in range(blocks):
        block = phrases.where(F.col("block") == k).select("phrase", "words").collect()
        if block:
            hits = saved(_search_block(index, block), "contamination-hits")
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _HITS)
    joined = found.groupBy("doc").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("phrases")).alias("phrases"))
    joined = joined.mapInArrow(_merge_spans, "doc long, spans array<struct<low: long, high: long>>, n_hit long, phrases array<long>")
    joined = saved(joined.withColumn("phrase_set", F.struct(F.xxhash64("phrases"), F.size("phrases"))), "contamination-docs")

    sets = joined.select("phrase_set", "phrases").dropDuplicates(["phrase_set"])
    held = sets.select("phrase_set", F.explode("phrases").alias("phrase")).join(windows.select("phrase", "item_text"), "phrase")
    held = held.select("phrase_set", "item_text").distinct().join(named, "item_text")
    held = held.groupBy("phrase_set").agg(
        F.array_sort(F.collect_set("item")).alias("item_names"), F.sum(F.col("item").isNull().cast("long")).alias("nameless")
    )
    held = saved(held, "contamination-items")

    kept = index.select(F.explode(F.arrays_zip("docs", "ids", "fresh")).alias("x")).select("x.*")
    kept = kept.groupBy("docs").agg(F.max(F.struct("ids")).alias("id"), F.sum("fresh").alias("n_words"))
    joined = joined.drop("phrases").join(held, "phrase_set", "left")
    whole = kept.join(joined, kept["docs"] == joined["doc"], "left")
    none = F.array().cast("array<string>")
    return whole.select(
        F.col("id.ids").alias(id_col),
        F.col("n_words").alias("_n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("_n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<low: long, high: long>>")).alias("_spans"),
        F.coalesce(F.size("item_names").cast("long") + F.col("nameless"), F.lit(0).cast("long")).alias("_n_items"),
        F.coalesce("item_names", none).alias("_items"),
    )
