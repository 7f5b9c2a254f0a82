"""Centroid clustering of integer vectors by bit planes and popcounts.

A vector's components are written as two's complement numbers of P bits. Bit p of all 64
components makes one 64-bit word, a bit plane, so a vector is P words. The dot product of two
vectors is then a weighted sum of popcounts:

    v . c = sum over planes p, q of w(p) w(q) popcount(V[p] & C[q]),  w(p) = 2**p, or -2**p for the sign plane

and so is |v|², so squared distances are exact integers. Rounds of assigning and averaging
read the packed table, written once; each round brings only the sums of the clusters, 64
numbers for each, to the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import finite_vector, saved

DIM = 64
SCALE = 64
BLOCK = 4096  # vectors scored at once
MOST = 2**26  # distances of vectors with larger components may not fit a long


def planes_of(x: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of integer vectors: one row of ``bits`` 64-bit words for each row of 64 components."""
    out = np.empty((len(x), bits), np.uint64)
    for p in range(bits):
        bit = ((x >> p) & 1).astype(np.uint8)
        out[:, p] = np.packbits(bit, axis=1, bitorder="little").view("<u8").ravel()
    return out


def bits_for(low: int, high: int) -> int:
    """Bits of the shortest two's complement form that holds both numbers."""
    return max(int(v if v >= 0 else ~v).bit_length() for v in (low, high)) + 1


def weights(bits: int) -> np.ndarray:
    w = 1 << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def distances(v: np.ndarray, c: np.ndarray, bits: int) -> np.ndarray:
    """Squared distances of packed vectors to packed centroids, one column for each centroid."""
    w = weights(bits)

    def dots(a, b):
        out = np.zeros(np.broadcast_shapes(a[..., 0].shape, b[..., 0].shape), np.int64)
        for p in range(bits):
            for q in range(bits):
                out += np.bitwise_count(a[..., p] & b[..., q]) * (w[p] * w[q])
        return out

    return dots(v, v)[:, None] - 2 * dots(v[:, None, :], c[None, :, :]) + dots(c, c)[None, :]


def sums(v: np.ndarray, cluster: np.ndarray, k: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of vectors and sum of each component, by cluster."""
    order = np.argsort(cluster, kind="stable")
    count = np.bincount(cluster, minlength=k)
    ends = np.cumsum(count)
    total = np.zeros((k, DIM), np.int64)
    w = weights(bits)
    for j in np.flatnonzero(count).tolist():
        own = v[order[ends[j] - count[j] : ends[j]]]
        for p in range(bits):
            ones = np.unpackbits(np.ascontiguousarray(own[:, p : p + 1]).astype("<u8").view(np.uint8), axis=1, bitorder="little")
            total[j] += w[p] * ones.sum(axis=0, dtype=np.int64)
    return count, total


def _packed_of(batch: pa.RecordBatch, bits: int) -> np.ndarray:
    flat = batch.column("_planes").flatten().to_numpy(zero_copy_only=False)
    return flat.view(np.uint64).reshape(batch.num_rows, bits)


def _pack(bits: int):
    def run(batches):
        for batch in batches:
            x = batch.column("_q").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, DIM)
            words = planes_of(x, bits).view(np.int64)
            ends = pa.array(np.arange(0, words.size + 1, bits, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.ListArray.from_arrays(ends, pa.array(words.ravel()))], ["_id", "_planes"])

    return run


def _nearest(v: np.ndarray, centroids: np.ndarray, bits: int):
    """For each block: its slice, the nearest centroids (the smaller number of equally near ones) and the distances."""
    for at in range(0, len(v), BLOCK):
        d = distances(v[at : at + BLOCK], centroids, bits)
        best = d.argmin(axis=1)
        yield slice(at, at + len(d)), best, d[np.arange(len(d)), best]


def _partial_sums(centroids: np.ndarray, bits: int):
    packed = planes_of(centroids, bits)

    def run(batches):
        k = len(packed)
        count, total = np.zeros(k, np.int64), np.zeros((k, DIM), np.int64)
        for batch in batches:
            v = _packed_of(batch, bits)
            for part, best, _ in _nearest(v, packed, bits):
                n, s = sums(v[part], best, k, bits)
                count += n
                total += s
        cluster = np.repeat(np.arange(k), DIM + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster), pa.array(np.tile(np.arange(DIM + 1), k)), pa.array(np.c_[total, count].ravel())], ["cluster", "place", "amount"]
        )

    return run


def _assigned(centroids: np.ndarray, bits: int):
    packed = planes_of(centroids, bits)

    def run(batches):
        for batch in batches:
            v = _packed_of(batch, bits)
            cluster, distance = np.zeros(len(v), np.int32), np.zeros(len(v), np.int64)
            for part, best, d in _nearest(v, packed, bits):
                cluster[part], distance[part] = best, d
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(cluster), pa.array(distance)], ["_id", "_cluster", "_distance"])

    return run


def centroid_clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector that takes part: the id, _cluster, _distance, _cluster_inertia, _inertia, _centroid_sha256, _centroid.

    Components are floor(64 * x). Vectors that are NULL, are not of 64 components or hold NULL
    or non-finite ones take no part. The first centroids are the ``k`` vectors of smallest
    sha256 of ``seed:id``; ids that repeat tie and go by their components, a NULL id comes
    last. Each of ``rounds`` rounds takes every vector to the nearest centroid (ties: the
    smaller number) and replaces each centroid that got vectors by the floor of their mean;
    then vectors are assigned once more. Fewer vectors than ``k``: as many centroids. Rows
    that repeat each count. No vectors: no rows. Other columns do not matter, whatever their
    names. ValueError for |x| of 2**20 or more, whose squared distances may not fit a long.
    """
    spark = vectors.sparkSession
    x = F.transform(F.col(vector_col), lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    fits = (F.size(vector_col) == DIM) & finite_vector(F.col(vector_col))
    # a component too large for a long is cut by the cast, and refused below
    rows = vectors.where(fits).select(F.col(id_col).alias("_id"), F.transform(x, lambda c: F.greatest(F.lit(-MOST - 1), F.least(F.lit(MOST + 1), c)).cast("long")).alias("_q"))
    low, high = rows.agg(F.min(F.array_min("_q")), F.max(F.array_max("_q"))).first()
    out = "_id {kind}, _cluster int, _distance long".format(kind=vectors.schema[id_col].dataType.simpleString())
    if low is None:
        none = spark.createDataFrame([], out + ", _cluster_inertia long, _inertia long, _centroid_sha256 string, _centroid array<long>")
        return none.withColumnRenamed("_id", id_col)
    if low <= -MOST or high >= MOST:
        raise ValueError(f"components of 2**20 or more: a squared distance may not fit a long ({low}, {high})")
    bits = bits_for(low, high)
    packed = saved(rows.mapInArrow(_pack(bits), f"_id {vectors.schema[id_col].dataType.simpleString()}, _planes array<long>"), "clusters-planes")

    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    first = rows.orderBy(named.asc_nulls_last(), "_q").limit(k).collect()
    centroids = np.array([r["_q"] for r in first], np.int64)
    for _ in range(rounds):
        parts = packed.select("_planes").mapInArrow(_partial_sums(centroids, bits), "cluster long, place long, amount long")
        found = parts.groupBy("cluster", "place").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).collect()
        total = {(r["cluster"], r["place"]): int(r["amount"]) for r in found}
        for j in range(len(centroids)):
            if total.get((j, DIM)):
                centroids[j] = [total[j, i] // total[j, DIM] for i in range(DIM)]

    assigned = saved(packed.mapInArrow(_assigned(centroids, bits), out), "clusters-assigned")
    by_cluster = assigned.groupBy("_cluster").agg(F.sum(F.col("_distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["_cluster"]: int(r["s"]) for r in by_cluster}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    number = F.col("_cluster") + 1
    return assigned.select(
        F.col("_id").alias(id_col),
        "_cluster",
        "_distance",
        F.element_at(F.lit([inertia.get(j, 0) for j in range(len(centroids))]), number).cast("long").alias("_cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("_inertia"),
        F.element_at(F.lit(digests), number).alias("_centroid_sha256"),
        F.element_at(F.array(*[F.lit(c) for c in centroids.tolist()]), number).cast("array<long>").alias("_centroid"),
    )
