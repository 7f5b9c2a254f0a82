"""Removal of long repeated byte strings by longest previous factors in suffix order, bucket by bucket.

A byte is repeated when it lies in a string of ``span`` bytes that also starts elsewhere, in
the same text or another; strings never cross texts. Only factors of ``span`` bytes count, so
suffixes are compared up to that length, and only those that can meet are sorted together:
every string of ``span`` bytes has a smallest gram hash among its grams, equal strings have
equal ones, so texts are cut into runs of neighbouring strings with the same smallest gram.

1. Runs with equal bytes around are collapsed into one with a count (partial aggregation by a
   hash of these bytes); in a run that occurs twice, every string is repeated. Runs whose
   gram occurs nowhere else hold no repeats.
2. One run for each distinct content left is sent, with its bytes, to the bucket of its gram.
   There its strings, the suffixes cut at ``span`` bytes, are sorted with the lengths of the
   prefixes that neighbours share. Previous and next smaller positions in that order give
   each suffix its longest previous factor: one of ``span`` bytes or more marks a later copy.
   The longer prefix shared with a neighbour is the longest factor found anywhere else.
3. Grams whose distinct runs hold very many bytes would fill a bucket; their strings are
   counted by hash instead, pre-aggregated, in any number of tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, pruned_joins, saved, scalar, trimmed, trimmed_group
from millrace.llm.words import mix, powers, texts_of

SPAN = 200
GRAM = 32
BLOCK = 1 << 20  # strings of one text handled at once
MANY = 1 << 22  # bytes of one gram's runs that a bucket takes
BUCKET = 1 << 20  # bytes of runs that a bucket should hold
SLICE = 100_000  # strings sorted at once
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
NO_ID = 2**63 - 1
_RUN_BITS = 21  # a run's place: start << _RUN_BITS | strings


def _sliding(a: np.ndarray, width: int, op: np.ufunc, pad: int) -> np.ndarray:
    """``op`` over each ``width`` neighbours, from running values of blocks in both directions."""
    n = len(a)
    x = np.full(-(-n // width) * width, pad, a.dtype)
    x[:n] = a
    x = x.reshape(-1, width)
    ahead = op.accumulate(x, axis=1).ravel()
    back = op.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - width + 1], ahead[width - 1 : n])


def _rolling(b: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` bytes."""
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b + np.uint64(1)) * powers(_BASE, len(b)), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(_INVERSE, len(b))[: len(b) - size + 1])


def runs_of(b: np.ndarray, span: int, gram: int):
    """Runs of string starts with one smallest gram: starts, counts, gram hashes, whether it occurs again in ``b``."""
    grams = _rolling(b, gram)
    width = span - gram + 1
    least = _sliding(grams, width, np.minimum, 2**64 - 1)
    starts = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
    counts = np.diff(np.r_[starts, len(least)])
    value = least[starts]
    # grams that are the smallest of some string; the same one twice may repeat a string within a run
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    chosen, times = np.unique(grams[_sliding(padded, width, np.maximum, 0) == grams], return_counts=True)
    return starts, counts, value, times[np.searchsorted(chosen, value)] > 1


def _find_runs(span: int, gram: int):
    def run(batches):
        for batch in batches:
            flat, cuts = texts_of(batch.column("text"))
            row, gram_hash, content, place, again = [], [], [], [], []
            for r in range(len(cuts) - 1):
                b = flat[cuts[r] : cuts[r + 1]]
                for at in range(0, len(b) - span + 1, BLOCK):
                    part = b[at : at + BLOCK + span - 1]
                    starts, counts, value, ties = runs_of(part, span, gram)
                    view = memoryview(part)
                    content += [xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(starts.tolist(), (starts + counts + span - 1).tolist(), strict=True)]
                    row.append(np.full(len(starts), r))
                    gram_hash.append(value)
                    place.append((starts + at << _RUN_BITS) | counts)
                    again.append(ties)
                if sum(map(len, row)) > 50_000 or r == len(cuts) - 2:
                    if row:
                        index = pa.array(np.concatenate(row))
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("id").take(index), batch.column("th").take(index), pa.array(np.concatenate(gram_hash).view(np.int64)),
                                pa.array(np.array(content, np.uint64).view(np.int64)), pa.array(np.concatenate(place)), pa.array(np.concatenate(again)),
                            ],
                            ["id", "th", "gram", "content", "place", "again"],
                        )
                    row, gram_hash, content, place, again = [], [], [], [], []

    return run


def _run_bytes(span: int):
    """The bytes around each run that is still open."""

    def run(batches):
        for batch in batches:
            flat, cuts = texts_of(batch.column("text"))
            ids, th, opened = batch.column("id"), batch.column("th"), batch.column("open").to_pylist()
            row, gram, place, size, data = [], [], [], [], []
            for r, some in enumerate(opened):
                text = flat[cuts[r] : cuts[r + 1]]
                for x in some or ():
                    start, count = x["place"] >> _RUN_BITS, x["place"] & ((1 << _RUN_BITS) - 1)
                    row.append(r)
                    gram.append(x["gram"])
                    place.append(start)
                    size.append(x["load"])
                    data.append(text[start : start + count + span - 1].tobytes())
                if len(data) > 10_000 or (r == len(opened) - 1 and data):
                    index = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(index), th.take(index), pa.array(gram, pa.int64()), pa.array(place, pa.int64()), pa.array(size, pa.int64()), pa.array(data, pa.binary())],
                        ["id", "th", "gram", "start", "load", "bytes"],
                    )
                    row, gram, place, size, data = [], [], [], [], []

    return run


def _smaller_before(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For suffixes in order: the prefix shared with the nearest one before that has a smaller position.

    ``shared`` holds the prefix that each shares with the one before it. All suffixes jump at
    once, over stretches that are known to hold no smaller position.
    """
    to, common = np.arange(len(position)) - 1, shared.copy()
    open_ = np.flatnonzero((to >= 0) & (position[to] > position))
    while len(open_):
        over = to[open_]
        common[open_], to[open_] = np.minimum(common[open_], common[over]), to[over]
        open_ = open_[(to[open_] >= 0) & (position[to[open_]] > position[open_])]
    return np.where(to >= 0, common, 0)


def factors(strings: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes given as rows of bytes, all of one length: the longest factor of each that starts anywhere else, and
    the longest that starts at a smaller position."""
    width = strings.shape[1]
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    ordered, place = strings[order], position[order]
    differs = ordered[1:] != ordered[:-1]
    shared = np.zeros(len(order) + 1, np.int64)  # with the suffix before
    shared[1:-1] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    before = _smaller_before(place, shared[:-1])
    after = _smaller_before(place[::-1], shared[:0:-1])[::-1]
    other, previous = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    other[order] = np.maximum(shared[:-1], shared[1:])
    previous[order] = np.maximum(before, after)
    return other, previous


def first_of_kind(strings: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For strings given as rows of bytes: how many are equal to each, and whether one of them has a smaller position.

    In suffix order equal strings are neighbours. Within such a stretch, a string has a
    previous or next smaller position exactly when it is not the stretch's least.
    """
    width = strings.shape[1]
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    ordered = strings[order]
    fresh = np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)]
    stretch = np.cumsum(fresh) - 1
    heads = np.flatnonzero(fresh)
    least = np.minimum.reduceat(position[order], heads)
    count = np.diff(np.r_[heads, len(order)])
    equal, later = np.empty(len(order), np.int64), np.empty(len(order), bool)
    equal[order] = count[stretch]
    later[order] = position[order] > least[stretch]
    return equal, later


def _spans(starts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Covered stretches of sorted string starts."""
    fresh = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + span])
    return starts[fresh], np.r_[starts[fresh[1:] - 1], starts[-1:]] + span


def _in_suffix_order(span: int, keep_first: bool):
    def run(table):
        # positions: texts in order of (id, hash), strings in order of their start
        table = table.sort_by([("id", "ascending"), ("th", "ascending"), ("start", "ascending")]).combine_chunks()
        data = table["bytes"].combine_chunks().cast(pa.large_binary())
        flat, cuts = texts_of(data)
        sizes = np.diff(cuts) - span + 1
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        within = np.arange(len(run_of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = cuts[:-1][run_of] + within
        gram = table["gram"].to_numpy().view(np.uint64)
        hashes = mix(_rolling(flat, span)[at] ^ gram[run_of])
        # a string whose hash is unique here has no equal
        order = np.argsort(hashes, kind="stable")
        fresh = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
        alone = fresh & np.r_[fresh[1:], True]
        order, fresh = order[~alone], fresh[~alone]
        windows = sliding_window_view(flat, span)
        found = np.zeros(len(run_of), bool)
        heads = np.flatnonzero(fresh)
        first = 0
        while first < len(heads):  # slices of whole groups of equal hashes
            last = max(first + 1, int(np.searchsorted(heads, heads[first] + SLICE)))
            part = order[heads[first] : heads[last] if last < len(heads) else len(order)]
            if len(part) > SLICE:  # one string that occurs very often: told from others of its hash by its bytes
                alike = np.concatenate([(windows[at[part[a : a + SLICE]]] == windows[at[part[0]]]).all(axis=1) for a in range(0, len(part), SLICE)])
                often, part = part[alike], part[~alike]
                found[often] = often > often.min() if keep_first else len(often) > 1
            if len(part):
                other, previous = factors(windows[at[part]], part)
                found[part] = (previous if keep_first else other) >= span
            first = last
        hit = np.flatnonzero(found)
        base = table["start"].to_numpy()[run_of[hit]] + within[hit]
        out = {"row": [], "low": [], "high": []}
        bounds = np.searchsorted(run_of[hit], np.arange(len(sizes) + 1))
        for r in np.unique(run_of[hit]).tolist():
            low, high = _spans(base[bounds[r] : bounds[r + 1]], span)
            out["row"].append(np.full(len(low), r))
            out["low"].append(low)
            out["high"].append(high)
        none = [np.zeros(0, np.int64)]
        row, low, high = (np.concatenate(v or none) for v in out.values())
        index = pa.array(row)
        return pa.table({"id": table["id"].take(index), "th": table["th"].take(index), "low": low, "high": high})

    return run


def _strings(span: int):
    """One row per string of a run: its hash under the gram, and its place."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                b = np.frombuffer(r["bytes"], np.uint8)
                h = _rolling(b, span)
                n = len(h)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["id"]] * n, pa.int64()), pa.array([r["th"]] * n, pa.int64()), pa.array([r["gram"]] * n, pa.int64()),
                        pa.array(h.view(np.int64)), pa.array(r["start"] + np.arange(n)),
                    ],
                    ["id", "th", "gram", "hash", "start"],
                )

    return run


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches covered by the given ones."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    fresh = np.r_[True, low[1:] > reach[:-1]]
    return low[fresh], reach[np.r_[fresh[1:], True]]


def whole_characters(b: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches shrunk so that no UTF-8 character is cut."""
    start = np.flatnonzero(np.r_[(b & 0xC0) != 0x80, True])
    low = start[np.searchsorted(start, low)]
    high = start[np.searchsorted(start, high, "right") - 1]
    return low[low < high], high[low < high]


def _cut(span: int, characters: bool):
    def run(batches):
        for batch in batches:
            flat, cuts = texts_of(batch.column("text"))
            known, more = batch.column("known").to_pylist(), batch.column("more").to_pylist()
            rows = []
            for r in range(len(cuts) - 1):
                b = flat[cuts[r] : cuts[r + 1]]
                place = np.array(known[r] or [], np.int64)
                start = place >> _RUN_BITS
                low = np.r_[start, np.array([x["low"] for x in more[r] or ()], np.int64)]
                high = np.r_[start + (place & ((1 << _RUN_BITS) - 1)) + span - 1, np.array([x["high"] for x in more[r] or ()], np.int64)]
                low, high = merged(low, high)
                if characters:
                    low, high = whole_characters(b, low, high)
                inside = np.zeros(len(b) + 1, np.int8)
                inside[low] += 1
                inside[high] -= 1
                kept = b[np.cumsum(inside[:-1]) == 0].tobytes()
                rows.append((len(b), int((high - low).sum()), [{"low": x, "high": y} for x, y in zip(low.tolist(), high.tolist(), strict=True)], kept))
            n, removed, spans, kept = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), pa.array(kept, pa.binary()),
                ],
                ["id", "th", "n_bytes", "n_removed", "spans", "kept"],
            )

    return run


def text_key(id_col: str = "doc_id", text_col: str = "text"):
    """Columns that name a text in the result of ``cut_repeats``; a text without an id comes last."""
    given = F.col(id_col).cast("long")
    return F.coalesce(given, F.lit(NO_ID)).alias("id"), F.xxhash64(given.isNull(), F.col(text_col)).alias("th")


def cut_repeats(docs: DataFrame, span: int = SPAN, keep_first: bool = True, characters: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text that may lose bytes: id, th, n_bytes, n_removed, spans, kept.

    ``kept`` holds the bytes left, ``spans`` the maximal stretches removed as byte offsets.
    ``keep_first`` leaves the first of equal strings, by (id, hash of the text, start), and
    removes the others; without it all are removed. ``characters`` spares UTF-8 characters
    that only partly lie in a stretch. Strings are judged on the input. NULL is an empty
    text; texts shorter than ``span`` lose nothing. Texts are named by id and hash (see
    ``text_key``): rows that repeat both are one text, which is no copy of itself when the
    first is kept, and copies when all are removed. No rows: no rows.
    """
    rows = docs.select(*text_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    found = saved(rows.mapInArrow(trimmed(_find_runs(span, GRAM)), "id long, th long, gram long, content long, place long, again boolean"), "rep-runs")
    again = found.groupBy("gram").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("n"), F.max("again").alias("tie")).where("n > 1")
    again = saved(again.select("gram", "tie"), "rep-grams")
    all_runs = found
    with pruned_joins(docs.sparkSession):
        found = saved(all_runs.drop("again").join(again.where("gram IS NOT NULL"), "gram"), "rep-again")
    dropped(all_runs, again)

    own = F.struct("id", "th", "place")
    classes = found.groupBy("gram", "content").agg(F.count("*").alias("n"), F.min(own).alias("first"), F.max("tie").alias("tie"))
    # the load of a gram: the bytes of its distinct runs
    size = F.col("first.place").bitwiseAND(F.lit((1 << _RUN_BITS) - 1)) + F.lit(span - 1)
    kinds = classes.groupBy("gram").agg(F.sum(size).alias("load"), (F.count("*") > 1).alias("several"))
    classes = classes.join(kinds, "gram")
    is_open = F.col("several") | F.col("tie")
    classes = classes.where((F.col("n") > 1) | is_open).select("gram", "content", "n", "first", F.when(is_open, F.col("load")).alias("load"))
    placed = found.drop("tie").join(classes, ["gram", "content"])
    mine = own == F.col("first")
    sure = (F.col("n") > 1) & (F.lit(not keep_first) | ~mine)
    per_text = placed.groupBy("id", "th").agg(
        F.collect_set(F.when(sure, F.col("place"))).alias("known"),  # rows that repeat have equal places
        F.collect_set(F.when(mine & F.col("load").isNotNull(), F.struct("gram", "place", "load"))).alias("open"),
    )
    per_text = saved(per_text, "rep-per-text")
    dropped(found)
    with pruned_joins(docs.sparkSession):
        # rows that repeat id and text are collapsed before the lists come to them
        texts = rows.join(per_text.where("th IS NOT NULL").select("id", "th"), ["id", "th"], "left_semi").dropDuplicates(["id", "th"])
        texts = saved(texts.join(per_text, ["id", "th"]), "rep-texts")
    dropped(per_text)

    opened = texts.where(F.size("open") > 0).select("id", "th", "text", "open").mapInArrow(trimmed(_run_bytes(span)), "id long, th long, gram long, start long, load long, bytes binary")
    opened = saved(opened, "rep-open")
    few = opened.where(F.col("load") <= MANY)
    buckets = scalar(few.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0)))) // BUCKET + 1
    few = few.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)))
    spans = few.groupBy("bucket").applyInArrow(trimmed_group(_in_suffix_order(span, keep_first)), "id long, th long, low long, high long")
    strings = opened.where(F.col("load") > MANY).mapInArrow(_strings(span), "id long, th long, gram long, hash long, start long")
    place = F.struct("id", "th", "start")
    same_string = strings.groupBy("gram", "hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    strings = strings.join(same_string, ["gram", "hash"]).where(F.lit(not keep_first) | (place != F.col("first")))
    spans = saved(spans.unionByName(strings.select("id", "th", F.col("start").alias("low"), (F.col("start") + span).alias("high"))), "rep-spans")
    dropped(opened)

    more = spans.groupBy("id", "th").agg(F.collect_list(F.struct("low", "high")).alias("more"))
    whole = texts.drop("open").join(more, ["id", "th"], "left")
    whole = whole.where((F.size("known") > 0) | F.col("more").isNotNull())
    return whole.select("id", "th", "text", "known", "more").mapInArrow(trimmed(_cut(span, characters)), "id long, th long, n_bytes long, n_removed long, spans array<struct<low: long, high: long>>, kept binary")
