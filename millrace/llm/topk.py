"""Exact top-k by inner product of quantised vectors: distributed histogram selection.

Every query is scored against every row, block against block. Each pass adds up a histogram
of scores per query, finds the bin that holds the k-th largest score, and narrows the range
to that bin, until the k-th score is known. A last pass keeps the rows above it and, of those
that equal it, the smallest ids. A block sends no bin below its own k-th score: the k-th
score overall is never below that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import dropped, finite_vector, saved, scalar

BINS = 1024
QUERY_BLOCK = 2048
ROW_BLOCK = 4096
TILE = 128


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def _scores(left: pa.Table, right: pa.Table, dim: int):
    """Tiles of exact scores as (first query, matrix); a row's score with itself is the least integer."""
    q, c = _matrix(left["q"], dim), _matrix(right["q"], dim)
    ids, qids = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dim, 1)
    kind = np.float64 if most < 2.0**53 else np.int64
    q, c = q.astype(kind), np.ascontiguousarray(c.T.astype(kind))
    for at in range(0, len(q), TILE):
        s = (q[at : at + TILE] @ c).astype(np.int64)
        s[qids[at : at + TILE, None] == ids[None, :]] = np.iinfo(np.int64).min
        yield at, s


def _histogram(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "bin": [], "n": []}
        if left.num_rows and right.num_rows:
            qids, low, shift = (left[c].to_numpy() for c in ("query_id", "low", "shift"))
            high = left["high"].to_numpy()
            for at, s in _scores(left, right, key[2].as_py()):
                part = slice(at, at + len(s))
                inside = (s >= low[part, None]) & (s <= high[part, None])
                bins = np.where(inside, (s - low[part, None]) >> shift[part, None], BINS)
                flat = bins + np.arange(len(s))[:, None] * (BINS + 1)
                n = np.bincount(flat.ravel(), minlength=len(s) * (BINS + 1)).reshape(len(s), BINS + 1)[:, :BINS]
                above = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n
                rows, cols = np.nonzero((n > 0) & (above < k))
                out["query_id"].append(qids[part][rows])
                out["bin"].append(cols)
                out["n"].append(n[rows, cols])
        none = np.zeros(0, np.int64)
        return pa.table({c: np.concatenate(v or [none]).astype(np.int64) for c, v in out.items()})

    return run


def _select(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            qids, low, ids = left["query_id"].to_numpy(), left["low"].to_numpy(), right["vec_id"].to_numpy()
            for at, s in _scores(left, right, key[2].as_py()):
                rows, cols = np.nonzero((s >= low[at : at + len(s), None]) & (s > np.iinfo(np.int64).min))
                score = s[rows, cols]
                order = np.lexsort((ids[cols], -score, rows))
                rows, cols, score = rows[order], cols[order], score[order]
                first = np.searchsorted(rows, np.arange(len(s)))
                keep = np.arange(len(rows)) - first[rows] < k
                out["query_id"].append(qids[at : at + len(s)][rows[keep]])
                out["vec_id"].append(ids[cols[keep]])
                out["score"].append(score[keep])
        none = np.zeros(0, np.int64)
        return pa.table({c: np.concatenate(v or [none]).astype(np.int64) for c, v in out.items()})

    return run


def exact_top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each query, ties to the smaller id.

    Components become ``floor(scale * x)``; the score is their integer inner product, which
    must fit a long. Queries are the rows whose id is divisible by ``every``; a row is never
    an answer to itself. Vectors that are NULL or hold NULL or non-finite components, and rows
    without an id, take no part. Vectors of different length are not compared. Rows that
    repeat an id count once, with the smallest vector. Fewer than ``k`` rows: all of them.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(F.col("vec_id").isNotNull() & finite_vector(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    quantised = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = saved(rows.select("vec_id", quantised.alias("q")).withColumn("dim", F.size("q")), "topk-rows")
    size, n_queries, longest = rows.agg(
        F.count("*"), F.count_if(F.col("vec_id") % every == 0),
        F.max(F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))),
    ).first()
    row_blocks, query_blocks = -(-size // ROW_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1
    # no score is beyond the product of the two longest vectors
    bound = int((longest or 0.0) * (1 + 1e-9)) + 1
    shift = max(0, (2 * bound + 1).bit_length() - BINS.bit_length() + 1)

    keys = ["qb", "rb", "dim"]
    block = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    right = rows.withColumn("rb", block(row_blocks, 1)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("q").alias("q"), F.col("dim").alias("dim"), block(query_blocks, 2).alias("qb")
    )
    spread = lambda q: q.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))).groupBy(*keys)
    state = queries.select("query_id", F.lit(-bound).cast("long").alias("low"), F.lit(bound).cast("long").alias("high"), F.lit(shift).cast("long").alias("shift"), F.lit(0).cast("long").alias("above"))
    kept = None
    while True:
        bins = spread(queries.join(state, "query_id")).cogroup(right.groupBy(*keys)).applyInArrow(_histogram(k), "query_id long, bin long, n long")
        bins = bins.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        bins = bins.withColumn("up_to", F.sum("n").over(down)).join(state, "query_id")
        found = bins.where(F.col("above") + F.col("up_to") >= k).groupBy("query_id").agg(F.max("bin").alias("bin"), F.max_by(F.col("up_to") - F.col("n"), "bin").alias("more"))
        low = F.col("low") + F.expr("bin * shiftleft(1L, cast(shift as int))")
        # a query with fewer than k rows takes them all
        short = F.col("bin").isNull()
        width = F.expr("shiftleft(1L, cast(shift as int))")
        state = state.join(found, "query_id", "left").select(
            "query_id", F.when(short, F.lit(-bound)).otherwise(low).alias("low"),
            F.when(short, F.lit(-bound)).otherwise(F.least(F.col("high"), low + width - 1)).alias("high"),
            F.greatest(F.lit(0), F.col("shift") - (BINS.bit_length() - 1)).cast("long").alias("shift"),
            F.when(short, F.col("above")).otherwise(F.col("above") + F.col("more")).alias("above"),
        )
        past, state = kept, saved(state, "topk-state")
        kept = state
        if past is not None:
            dropped(past)
        if not scalar(state.agg(F.max(F.col("high") - F.col("low")))):
            break
    hits = spread(queries.join(state, "query_id")).cogroup(right.groupBy(*keys)).applyInArrow(_select(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
