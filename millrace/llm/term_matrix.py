"""A sparse document-term matrix in CSR shards, over one dictionary of all words.

Texts are dealt into shards by size. A shard's words are split and dictionary-encoded by Arrow,
and (text, word) pairs are counted into rows of columns and counts, the columns in order of
their words' hashes. Words of all shards then meet by ranges of that hash: each range gives its
words ids, one for all shards, and sends each shard the ids of its own columns. Shards, and
blocks of their words, are all that is shuffled, never single entries or single words. A text
longer than a piece is counted piece by piece, so that only its distinct words are held
beside it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.common import saved, scalar, trimmed
from millrace.llm.words import _BLANK, mix, powers, texts_of

_SPLIT = r"[\x20\x09-\x0D]+"
PIECE = 2 << 20  # bytes of one text that are split at once
SHARD = 4 << 20  # bytes of text in a shard, about
RANGE = 1 << 19  # words of all shards that a range of hashes should hold
_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The text number and the word, for all words of the texts."""
    lists = pc.split_pattern_regex(texts, _SPLIT)
    words = lists.flatten()
    row = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = pc.not_equal(pc.binary_length(words), 0)
    return row[some.to_numpy(zero_copy_only=False)], words.filter(some)


def _cut(text: bytes):
    """Pieces of a long text, cut at blanks."""
    b = np.frombuffer(text, np.uint8)
    at = 0
    while at < len(b):
        end = min(len(b), at + PIECE)
        while end < len(b):
            gaps = np.flatnonzero(_BLANK[b[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(b), end + PIECE)
        yield text[at:end].decode()
        at = end


def _spread(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, that deals words over ranges; words may share one."""
    b, cuts = texts_of(words)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b + np.uint64(1)) * powers(_BASE, len(b)), out=total[1:])
    return mix((total[cuts[1:]] - total[cuts[:-1]]) * powers(_INVERSE, len(b) + 1)[cuts[:-1]])


def _counted(rows: list[np.ndarray], words: list[pa.Array], weights: list[np.ndarray | None], texts: int):
    """CSR rows over the distinct words, in order of their hashes: (distinct words, row ends, columns, counts)."""
    encoded = (pa.concat_arrays(words) if len(words) > 1 else words[0]).dictionary_encode()
    distinct = encoded.dictionary
    size = max(1, len(distinct))
    order = np.argsort(_spread(distinct), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    key = np.concatenate(rows) * np.int64(size) + place[encoded.indices.to_numpy(zero_copy_only=False)]
    if any(w is not None for w in weights):
        weight = np.concatenate([np.ones(len(r), np.int64) if w is None else w for r, w in zip(rows, weights, strict=True)])
        key, back = np.unique(key, return_inverse=True)
        count = np.bincount(back, weights=weight, minlength=len(key)).astype(np.int64)
    else:
        key, count = np.unique(key, return_counts=True)
    ends = np.searchsorted(key, np.arange(texts + 1) * size)
    return distinct.take(pa.array(order)), ends, key % size, count


def _narrow(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane: planes of zeros take no room once compressed."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _wide(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _steps(columns: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Columns, which rise within a row, as steps from the one before; a row starts from 0."""
    out = np.diff(columns, prepend=0)
    first = ends[:-1][ends[:-1] < ends[1:]]
    out[first] = columns[first]
    return out


def _columns(steps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(steps, dtype=np.int64)]
    return total[1:] - np.repeat(total[ends[:-1]], np.diff(ends))


def _shards(carried: int, measure: Callable[[pa.Array], pa.Array] | None = None):
    """One row for each shard: carried columns as lists, row ends, columns and counts, and the words of the columns."""

    def shard_of(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
        column = batch.column(carried)
        column = column.fill_null("") if column.null_count else column
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
        long = np.flatnonzero(sizes > PIECE)
        short = pc.if_else(pa.array(sizes > PIECE), pa.scalar("", pa.string()), column) if len(long) else column
        row, words = _words(short)
        rows, parts, weights = [row], [words], [None]
        for r in long.tolist():
            for piece in _cut(column[r].as_buffer().to_pybytes()):
                counts = pc.value_counts(_words(pa.array([piece]))[1])
                rows.append(np.full(len(counts), r, np.int32))
                parts.append(counts.field("values"))
                weights.append(counts.field("counts").to_numpy(zero_copy_only=False))
        words, ends, terms, count = _counted(rows, parts, weights, len(column))
        names, carry = batch.schema.names[:carried], batch.columns[:carried]
        if measure:
            names, carry = [*names, "measure"], [*carry, measure(column)]
        lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), c) for c in carry]
        binary = [pa.array([x], pa.binary()) for x in (ends.astype("<i8").tobytes(), _narrow(_steps(terms, ends)), _narrow(count))]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *lists, *binary, pa.array([len(words)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)],
            ["shard", *names, "ends", "columns", "counts", "n_words", "words"],
        )

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            cuts = texts_of(batch.column(carried))[1]
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + SHARD, "right")) - 1)
                yield shard_of(batch.slice(at, end - at), number)
                number, at = number + 1, end

    return run


def _by_range(ranges: int):
    """A shard's words, cut into the ranges of their hashes."""
    starts = np.array([(k << 64) // ranges for k in range(ranges)], np.uint64)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                words = batch.column("words")[r].values
                hashes = _spread(words)  # in order already
                ends = np.r_[np.searchsorted(hashes, starts), len(words)].astype(np.int32)
                some = np.flatnonzero(ends[1:] > ends[:-1])
                cuts = pa.array(np.r_[ends[some], len(words)].astype(np.int32))
                shard = pa.array(np.full(len(some), batch.column("shard")[r].as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(some), shard, pa.ListArray.from_arrays(cuts, words)], ["range", "shard", "words"])

    return run


def _numbered(batches):
    """The ids of each shard's words, range after range, and the words of a range in order of their ids.

    Rows come sorted by range. A range's words are known once each; blocks pass one by one.
    """
    number, known = None, {}

    def new_words():
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([[w.decode() for w in known]], pa.list_(pa.string()))],
            ["range", "shard", "ids", "words"],
        )

    for batch in batches:
        for r in range(batch.num_rows):
            if batch.column("range")[r].as_py() != number:
                if known:
                    yield from new_words()
                number, known = batch.column("range")[r].as_py(), {}
            words = batch.column("words")[r].values.cast(pa.binary()).to_pylist()
            ids = np.array([known.setdefault(w, len(known)) for w in words], np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([batch.column("shard")[r].as_py()]), pa.array([ids.tobytes()], pa.binary()), pa.array([None], pa.list_(pa.string()))],
                ["range", "shard", "ids", "words"],
            )
    if known:
        yield from new_words()


def _with_terms(names: list[str]):
    """A shard with the global ids of its columns: the word's range and its number there."""

    def run(key, shard: pa.Table, ids: pa.Table) -> pa.Table:
        ids = ids.sort_by("range")
        blocks = [np.int64(k) << 32 | np.frombuffer(x.as_buffer(), "<i4") for k, x in zip(ids["range"].to_pylist(), ids["ids"], strict=True)]
        term = np.concatenate([np.zeros(0, np.int64), *blocks])
        columns = _columns(_wide(shard["columns"][0].as_buffer()), np.frombuffer(shard["ends"][0].as_buffer(), "<i8"))
        counts = _wide(shard["counts"][0].as_buffer())
        out = {name: shard[name] for name in ["shard", *names, "ends"]}
        return pa.table({**out, "terms": pa.array([term[columns].tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    return run


def term_matrix(
    docs: DataFrame, carry: dict[str, Column], text_col: str = "text", measure: Callable[[pa.Array], pa.Array] | None = None, measure_type: str = "int"
) -> tuple[DataFrame, DataFrame]:
    """The matrix and its dictionary: (shard, lists of the carried columns, ends, terms, counts) and (word, term).

    A row of the matrix is a shard: ``ends`` (int64) cuts ``terms`` (int64 ids) and ``counts``
    (uint32) into one stretch for each text, in the order of the lists; all three are binary,
    little-endian. ``measure`` makes one more carried column, ``measure``, of the texts as they
    pass. Words are runs of bytes other than space and tab to carriage return, case kept. NULL
    and empty texts have empty stretches; rows that repeat are rows of their own. No texts: no
    shards, no words. Columns that are not carried do not matter.
    """
    spark = docs.sparkSession
    rows = docs.select(*[c.alias(name) for name, c in carry.items()], F.col(text_col).cast("string").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields[:-1]} | ({"measure": measure_type} if measure else {})
    lists = ", ".join(f"`{name}` array<{kind}>" for name, kind in kinds.items())
    schema = f"shard long, {lists}, ends binary, columns binary, counts binary"
    with session.conf_set(spark, spark__sql__execution__arrow__maxBytesPerBatch=str(SHARD)):
        shards = saved(rows.mapInArrow(trimmed(_shards(len(carry), measure)), schema + ", n_words long, words array<string>"), "terms-shards")
    ranges = int(scalar(shards.agg(F.sum("n_words"))) or 0) // RANGE + 1
    blocks = shards.select("shard", "words").mapInArrow(trimmed(_by_range(ranges)), "range long, shard long, words array<string>")
    blocks = blocks.repartition(ranges, "range").sortWithinPartitions("range")
    found = saved(blocks.mapInArrow(trimmed(_numbered), "range long, shard long, ids binary, words array<string>"), "terms-ids")
    words = found.where("shard IS NULL").select("range", F.posexplode("words").alias("place", "word"))
    dictionary = words.select("word", F.shiftleft("range", 32).bitwiseOR(F.col("place").cast("long")).alias("term"))
    # a name of its own: both sides come from the same table
    ids = found.where("shard IS NOT NULL").select(F.col("shard").alias("of_shard"), "range", "ids")
    matrix = shards.drop("words", "n_words").groupBy("shard").cogroup(ids.groupBy("of_shard"))
    return matrix.applyInArrow(_with_terms(list(kinds)), schema.replace("columns binary", "terms binary")), dictionary
