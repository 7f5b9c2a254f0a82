"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter is a direction made of one codeword per block of components; a vector passes all
filters whose inner product with it exceeds a height. List decoding finds them block by
block, dropping partial sums that no continuation can lift over the height. Vectors that
share a filter are compared exactly, in double precision; a pair is counted by the first
filter it shares, so every linked pair counts once.

Height and number of filters follow from the number of vectors: a filter should hold about
``EXPECTED`` of them, and a pair at the threshold should share about twice log2 of their
number. Both come from the areas of caps on the sphere of these vectors' length; vectors of
few components get larger caps, so that the number of filters stays bounded. Filters are spread over log2 of it codes, each behind a rotation of its own. Filters
that hold more than ``BLOCK`` vectors are compared block against block, in tasks of their own;
tasks are dealt to buckets of about ``BUCKET`` vectors.
"""

from __future__ import annotations

from functools import cache
from math import acos, ceil, cos, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, finite_vector, saved, scalar
from millrace.llm.components import components

EXPECTED = 96
LEAST_CODES = 12
PARTS = 2
LEAST_SPLIT = 16  # components from which a filter has a codeword for each part
MOST_WORDS = 1 << 14  # codewords to a part
MOST_PASSED = 64  # filters of one code that a vector should pass at most
IDS = (1 << 31) - 1  # filters are told apart by so many ids; with more filters, some share one
BLOCK = 1024
BUCKET = 8192
SEED = 20240607


@cache
def _caps(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Angles, share of the unit sphere within each angle of a direction, and mass at each angle."""
    angles = np.linspace(0, pi, 100_001)
    density = np.sin(angles) ** (dim - 2)
    density /= density.sum()
    sums = np.cumsum(density) - density / 2
    return angles, sums / sums[-1], density


def _both_over(dim: int, height: float, cosine: float) -> float:
    """Probability that two unit vectors with this cosine both exceed ``height`` along a random direction."""
    angles, _, mass = _caps(dim)
    near = angles < acos(height)
    x, across = np.cos(angles[near]), np.sin(angles[near])
    least = np.clip((height - cosine * x) / np.maximum(sqrt(max(0.0, 1 - cosine * cosine)) * across, 1e-300), -1, 1)
    if dim == 2:  # across the direction there are two points
        rest = 0.5 * (least < 1) + 0.5 * (least <= -1)
    else:
        rest = np.interp(np.arccos(least), *_caps(dim - 1)[:2])
    return float((mass[near] * rest).sum())


class Filters:
    """Codes for vectors of one length, the same for the same arguments.

    Rotations are random, so a filter holds a cap's share of the sphere, whatever its direction.
    """

    def __init__(self, dim: int, count: int, cosine: float):
        share = min(0.25, EXPECTED / max(count, 1))
        parts = PARTS if dim >= LEAST_SPLIT else 1
        while True:
            self.height = cos(np.interp(share, _caps(dim)[1], _caps(dim)[0])) if dim > 1 else 0.0
            both = _both_over(dim, self.height, cosine) if dim > 1 else 0.5
            # vectors of few components have more neighbours than small caps can cover
            if share >= 0.25 or (both * MOST_WORDS**parts >= 2 and both * MOST_PASSED >= 2 * share):
                break
            share = min(0.25, share * 1.25)
        codes = max(LEAST_CODES, round(log2(max(count, 2))))
        per_code = 2 / both  # so all codes together share 2 * codes
        self.words = max(2, ceil(per_code ** (1 / parts)))
        self.cuts = np.linspace(0, dim, parts + 1).astype(int)
        rng = np.random.default_rng(SEED + dim)
        self.codes = []
        for _ in range(codes):
            turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            books = []
            for a, b in zip(self.cuts, self.cuts[1:], strict=False):
                book = rng.standard_normal((self.words, b - a))
                # a codeword's share of the direction is that of its block
                books.append(book / np.linalg.norm(book, axis=1, keepdims=True) * sqrt((b - a) / dim))
            self.codes.append((turn, books))

    def passed(self, unit: np.ndarray):
        """(row, filter) of all filters that each unit vector passes."""
        rows, filters = [], []
        size = self.words ** (len(self.cuts) - 1)
        for c, (turn, books) in enumerate(self.codes):
            x = unit @ turn
            scores = [x[:, a:b] @ book.T for a, b, book in zip(self.cuts, self.cuts[1:], books, strict=False)]
            if len(scores) == 1:
                row, word = np.nonzero(scores[0] > self.height)
            else:
                row, word = self._joined(*scores)
            rows.append(row)
            filters.append(word + c * size)
        return np.concatenate(rows), np.concatenate(filters)

    def _joined(self, left: np.ndarray, right: np.ndarray):
        """(row, pair of words) of all pairs whose scores add up to more than the height."""
        row, word = np.nonzero(left > self.height - right.max(axis=1)[:, None])
        other_row, other = np.nonzero(right > self.height - left.max(axis=1)[:, None])
        # best first in each row; scores lie between -1 and 1, so rows stay apart
        key = 4.0 * other_row - right[other_row, other]
        order = np.argsort(key)
        key, other = key[order], other[order]
        starts = np.searchsorted(other_row, row)
        n = np.maximum(np.searchsorted(key, 4.0 * row + left[row, word] - self.height) - starts, 0)
        at = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(row, n), np.repeat(word, n) * self.words + other[at]


def _decode(count: int, cosine: float):
    """Each vector with the filters it passes, in order; it may pass none."""

    def run(batches):
        made: dict[int, Filters] = {}
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_dim.setdefault(len(v), []).append(i)
            for dim, index in by_dim.items():
                if dim not in made:
                    made[dim] = Filters(dim, count, cosine)
                rows = batch.take(pa.array(index))
                m = np.array([vectors[i] for i in index], np.float64)
                unit = m / np.linalg.norm(m / np.abs(m).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(m).max(axis=1, keepdims=True)
                for a in range(0, len(index), 256):
                    row, filt = made[dim].passed(unit[a : a + 256])
                    pairs = np.unique(row.astype(np.int64) * IDS + filt % IDS)
                    row, filt = np.divmod(pairs, IDS)
                    n = np.bincount(row, minlength=min(256, len(index) - a))
                    ends = np.r_[0, np.cumsum(n)]
                    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(filt.astype(np.int32)))
                    part = rows.slice(a, 256)
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("copies"), pa.array([dim] * len(n), pa.int32()), part.column("v"), lists], ["id", "copies", "dim", "v", "filters"])

    return run


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column."""
    column = column.combine_chunks()
    bounds = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), bounds


def _shared_before(rows: np.ndarray, filters: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` vectors share one of the given (vector, filter) pairs."""
    _, column, times = np.unique(filters, return_inverse=True, return_counts=True)
    several = times[column] > 1
    rows, column = rows[several], np.unique(column[several], return_inverse=True)[1]
    out = np.zeros((n, n), np.float32)
    for a in range(0, int(column.max(initial=-1)) + 1, 4096):
        part = (column >= a) & (column < a + 4096)
        passes = np.zeros((n, 4096), np.float32)
        passes[rows[part], column[part] - a] = 1
        out += passes @ passes.T
    return out > 0


def _compare(cosine: float):
    """Per vector: copies of the vectors linked with it in a filter, and a vector of its component there."""

    def run(table):
        order = ["f", "dim", "i", "j", "id"]
        table = table.sort_by([(c, "ascending") for c in order]).combine_chunks()
        f, dim, i, j, ids = (table[c].to_numpy() for c in order)
        copies, block = table["copies"].to_numpy(), table["block"].to_numpy()
        (values, at), (filters, filters_at) = _lists(table["v"]), _lists(table["filters"])
        fresh = np.r_[True, (f[1:] != f[:-1]) | (dim[1:] != dim[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        bounds = np.r_[np.flatnonzero(fresh), len(f)]
        out = []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            m = values[at[s] : at[e]].reshape(e - s, dim[s]).astype(np.float64)
            m /= np.abs(m).max(axis=1, keepdims=True)
            m /= np.linalg.norm(m, axis=1, keepdims=True)
            linked = m @ m.T >= cosine
            np.fill_diagonal(linked, False)
            if i[s] != j[s]:  # blocks are compared with themselves elsewhere
                linked &= block[s:e, None] != block[None, s:e]
            near = np.flatnonzero(linked.any(axis=1))
            if not len(near):
                continue
            linked = linked[np.ix_(near, near)]
            # pairs that share an earlier filter were counted there
            rows = np.repeat(np.arange(e - s), np.diff(filters_at[s : e + 1]))
            passed = filters[filters_at[s] : filters_at[e]]
            place = np.full(e - s, -1)
            place[near] = np.arange(len(near))
            early = (passed < f[s]) & (place[rows] >= 0)
            new = linked & ~_shared_before(place[rows[early]], passed[early], len(near))
            label = np.arange(len(near))  # smallest position reachable; sorted by id
            x, y = np.nonzero(linked)
            while True:
                low = label.copy()
                np.minimum.at(low, x, label[y])
                low = low[low]
                if (low == label).all():
                    break
                label = low
            here = ids[s:e][near]
            out.append((here, new @ copies[s:e][near], here[label]))
        none = [np.zeros(0, np.int64)]
        return pa.table({name: np.concatenate([o[k] for o in out] or none) for k, name in enumerate(("id", "links", "to"))})

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: id, ``_links`` (vectors linked directly), ``_component`` (smallest id reachable).

    Vectors are linked when their cosine, in double precision, is at least ``cosine``. Equal
    vectors are collapsed first and counted as copies. Vectors that are NULL, zero, empty, or
    hold NULL or non-finite components link with nothing; nor do vectors of different length.
    Rows without an id are left out; rows that repeat an id count once, with the smallest
    vector. Every pair found is checked; the filters miss fewer than 1 in 1000 pairs at
    the threshold, and fewer still above it (measured in the tests). No rows: no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id IS NOT NULL")
    number = "float" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    # adding 0.0 turns -0.0 into 0.0, so that equal vectors have equal bits
    rows = rows.groupBy("id").agg(F.min(F.transform("v", lambda x: x.cast(number) + F.lit(0.0).cast(number))).alias("v"))
    rows = saved(rows.withColumn("ok", F.coalesce(finite_vector(F.col("v")) & F.exists("v", lambda x: x != 0), F.lit(False))), "vec-rows")
    classes = rows.where("ok").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = saved(classes, "vec-classes")
    count = scalar(classes.agg(F.count("*")))
    decoded = classes.select("id", "copies", "v").mapInArrow(_decode(count, cosine), f"id long, copies long, dim int, v array<{number}>, filters array<int>")
    decoded = saved(decoded, "vec-filters")
    held = decoded.select("dim", F.explode("filters").alias("f")).groupBy("f", "dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1")
    held = saved(held.select("f", F.col("dim").alias("d"), "blocks"), "vec-held")
    placed = decoded.withColumn("f", F.explode("filters"))
    placed = placed.join(held, (placed["f"] == held["f"]) & (placed["dim"] == held["d"])).drop(held["f"]).drop("d")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    with_all = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    placed = placed.withColumn("task", F.explode(with_all)).select("f", "dim", F.col("task.i").alias("i"), F.col("task.j").alias("j"), "id", "copies", "v", "filters", "block")
    tasks = scalar(placed.agg(F.count("*"))) // BUCKET + 1
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("f", "dim", "i", "j"), F.lit(tasks)))
    found = saved(placed.groupBy("bucket").applyInArrow(_compare(cosine), "id long, links long, to long"), "vec-found")
    dropped(decoded, held)

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")), "vec-components")
    names = joined.groupBy("root").agg(F.min("node").alias("first"))
    named = joined.join(names, "root").select(F.col("node").alias("id"), "first")
    classes = classes.join(links, "id", "left").join(named, "id", "left")
    classes = classes.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("first", "id").alias("first"))
    out = rows.where("ok").join(classes, "v").select("id", "links", "first")
    out = out.unionByName(rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("first")))
    return out.select(F.col("id").alias(id_col), F.col("links").alias("_links"), F.col("first").alias("_component"))
