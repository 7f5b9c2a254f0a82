"""Packing documents into token sequences by best fit, decreasing, over length classes.

Pieces of one length are interchangeable, so the state of the search is small: how many
pieces there are of each length, and runs of sequences with equal gaps. A sequential loop
on the driver stands in for bulk-synchronous matching. One turn per length, longest first:
its pieces, in rank order, meet the smallest gaps that can hold them (the successors of the length among the sorted gaps), a run of sequences against a run of
ranks at a time; gaps shrink, what is left opens new sequences, and the next length follows.
This gives the very placement of best-fit decreasing. Only the counts per length, at most
one row for each length up to the capacity, come to the driver; the placements it finds are
runs too, and Spark joins them with the ranked pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterable
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import saved

CAPACITY = 2048
END = 0  # id after every document
KNOWN = 700_000  # chunks of text whose ids a worker remembers; then it starts afresh
TOGETHER = 256  # words encoded at once
KNOWN_CHARACTERS = 32 << 20
RANKS = 64  # ranks to a cell of the join between pieces and placements
CELL = 50_000  # different pieces of one length that are ranked in one task, about


def place(counts: dict[int, int], capacity: int) -> Iterable[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, end rank, first sequence, offset), ranks and sequences running together."""
    gaps: list[int] = []  # sizes that have sequences, sorted
    runs: dict[int, deque] = {}
    sequences = 0

    def add(gap: int, a: int, b: int) -> None:
        if gap:
            if gap not in runs:
                runs[gap] = deque()
                insort(gaps, gap)
            runs[gap].append((a, b))

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                break
            gap = gaps[at]
            a, b = runs[gap].popleft()
            took = min(b - a, n - rank)
            if took < b - a:
                runs[gap].appendleft((a + took, b))
            elif not runs[gap]:
                del runs[gap], gaps[at]
            yield length, rank, rank + took, a, capacity - gap
            rank += took
            add(gap - length, a, a + took)
        each = capacity // length
        full, rest = divmod(n - rank, each)
        for j in range(each if full else 0):
            yield length, rank + j * full, rank + (j + 1) * full, sequences, j * length
        if full:
            add(capacity - each * length, sequences, sequences + full)
            sequences, rank = sequences + full, rank + each * full
        for j in range(rest):
            yield length, rank + j, rank + j + 1, sequences, j * length
        if rest:
            add(capacity - rest * length, sequences, sequences + 1)
            sequences += 1


class Encoder:
    """Token ids of texts, with the ids of repeated chunks remembered.

    A chunk is what stands between ASCII blanks, without a full stop or comma that ends it. A
    tokenizer that lower-cases and splits on white space and between letters and signs has no
    token across these places, so a text's ids are those of its chunks in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the same merges without the steps that leave a plain lower-case word as it is
        bare = json.loads(self.tokenizer.to_str())
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.held = 0
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        new, self.known.new = self.known.new, []
        self.held += sum(map(len, new))
        plain = [i for i, c in enumerate(new) if c.isalpha() and c == c.lower() and (c.isascii() or is_normalized("NFC", c))]
        is_plain = np.zeros(len(new), bool)
        is_plain[plain] = True
        rows = [[new[i] for i in plain[a : a + TOGETHER]] for a in range(0, len(plain), TOGETHER)]
        ids, sizes = [], np.zeros(len(new), np.int64)
        done = 0
        for row, e in zip(rows, self.bare.encode_batch([_spelled(" ".join(r)) for r in rows], add_special_tokens=False), strict=True):
            ids.append(np.array(e.ids, np.uint32))
            sizes[plain[done : done + len(row)]] = np.bincount(np.array(e.word_ids, np.int64), minlength=len(row))
            done += len(row)
        others = np.flatnonzero(~is_plain)
        rest = [e.ids for e in self.tokenizer.encode_batch([new[i] for i in others], add_special_tokens=False)]
        ids.append(np.array([t for x in rest for t in x], np.uint32))
        sizes[others] = [len(x) for x in rest]
        starts = np.zeros(len(new), np.int64)
        order = np.concatenate([np.array(plain, np.int64), others])
        starts[order] = len(self.flat) + np.cumsum(sizes[order]) - sizes[order]
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, *ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit numbers."""
        if len(self.known) > KNOWN or self.held > KNOWN_CHARACTERS:
            self._forget()
        get = self.known.__getitem__
        places = []
        for t in texts:
            chunks = _plain(t).split(" ")
            places.append(np.fromiter(map(get, chunks), np.int64, len(chunks)))
        if self.known.new:
            self._learn()
        out = []
        for at in places:
            n = self.sizes[at]
            ends = np.cumsum(n)
            out.append(self.flat[np.repeat(self.starts[at] - ends + n, n) + np.arange(ends[-1])])
        return out


class _Known(dict):
    """Place of each chunk; one not seen before gets the next place and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        place = self[chunk] = len(self)
        return place


# Byte-level spelling: bytes that print stand for themselves, the others for the characters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPELLING = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED) if b != 32}


def _spelled(words: str) -> str:
    return words if words.isascii() else words.encode().decode("latin-1").translate(_SPELLING)


_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
_STOP = re.compile("[.,](?<=[a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][.,])(?= |\\Z)")  # \u0130 ends in a sign when lower-cased


def _plain(text: str) -> str:
    """A text whose chunks stand between single blanks."""
    data = text.encode()
    if b"<|" in data:  # special tokens have their own case
        return data.translate(_BLANKS).decode()
    # letters join with combining marks (these bytes start them) before the case goes
    marks = b"\xcc" in data or b"\xcd" in data
    return _STOP.sub(r" \g<0>", data.translate(_BLANKS if marks else _LOWER).decode())


@cache
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(path)


def _pieces(tokenizer: str, capacity: int):
    def run(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(ids):  # about a megabyte of text at a time
                end, held = at, 0
                while end < len(ids) and (end == at or held < 1 << 20):
                    held += len(texts[end] or "")
                    end += 1
                out = {"id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
                for i, tokens in zip(ids[at:end], encoder.encode([t or "" for t in texts[at:end]]), strict=True):
                    tokens = np.append(tokens, np.uint32(END)).astype("<u4")
                    for k, start in enumerate(range(0, len(tokens), capacity)):
                        part = tokens[start : start + capacity]
                        for name, value in zip(out, (i, k, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
                at = end

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file, readable on every executor; it must be
    a byte-level BPE that lower-cases, and splits on white space and between letters and signs
    (see ``Encoder``). A document's ids are those of its text (NULL: none) and then
    0; only documents longer than ``capacity`` are cut, into pieces of that length and a last
    one. Pieces in a sequence follow each other from offset 0 without gaps, in the order in
    which they were placed. Rows that repeat are packed each; rows without an id keep NULL.
    No rows: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = rows.mapInArrow(_pieces(tokenizer, capacity), "id long, piece int, start long, length long, ids_crc32 long")
    # pieces that repeat, such as those of all empty texts without an id, are one run of ranks
    pieces = pieces.groupBy("id", "piece", "start", "length", "ids_crc32").agg(F.count("*").alias("n"))
    pieces = saved(pieces, "pack-pieces")
    by_length = pieces.groupBy("length").agg(F.sum("n").alias("n"), F.ceil(F.count("*") / CELL).alias("cells")).collect()  # at most `capacity` rows
    plan = list(place({r["length"]: r["n"] for r in by_length}, capacity))
    columns = zip(*plan, strict=True) if plan else [[]] * 5
    table = pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("length", "low", "high", "sequence", "offset"), columns, strict=True)})
    plan = spark.createDataFrame(table)
    plan = plan.withColumn("block", F.explode(F.expr(f"sequence(low div {RANKS}, (high - 1) div {RANKS})")))

    # rank among the pieces of a length: those in earlier cells, then the place in the own cell
    lengths = spark.createDataFrame([(r["length"], r["cells"]) for r in by_length], "length long, cells long")
    celled = pieces.join(lengths, "length").withColumn("cell", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.col("cells"))).drop("cells")
    cells = celled.groupBy("length", "cell").agg(F.sum("n").alias("held"))
    before = F.sum("held").over(Window.partitionBy("length").orderBy("cell")) - F.col("held")
    own = F.sum("n").over(Window.partitionBy("length", "cell").orderBy("id", "piece", "ids_crc32", "start").rowsBetween(Window.unboundedPreceding, 0))
    ranked = celled.withColumn("own", own - F.col("n")).join(cells.select("length", "cell", before.alias("before")), ["length", "cell"])
    ranked = ranked.withColumn("first", F.col("before") + F.col("own")).withColumn("last", F.col("first") + F.col("n"))
    ranked = ranked.withColumn("block", F.explode(F.expr(f"sequence(first div {RANKS}, (last - 1) div {RANKS})")))
    out = ranked.join(plan, ["length", "block"])
    begin, end = F.greatest("first", "low", F.col("block") * RANKS), F.least("last", "high", (F.col("block") + 1) * RANKS)
    out = out.where(begin < end).withColumn("rank", F.explode(F.sequence(begin, end - 1)))
    return out.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"
    )
