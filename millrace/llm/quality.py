"""Quality classifier from weak labels.

Heuristic labellers, most of them for one kind of junk, vote good, junk or nothing on each text. Expectation-maximisation finds
how accurate each of them is without any true label, from how often they agree, over all
texts: votes are counted per combination, at most 3 ** labellers rows. The posterior of each
combination then labels a bounded sample of texts, on which a linear scorer over hashed byte
trigrams is fitted; the scorer judges every text, also those on which no labeller votes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import saved, trimmed
from millrace.llm.words import BLOCK, texts_of, word_hashes

SAMPLE = 3000  # distinct texts the scorer is fitted on, at most; all others only enter the vote counts
FEATURES = 4096
STRETCH = 1 << 14
KEEP = 0.5  # texts that score less are rejected
LABELLERS = ("symbols", "capitals", "exclamations", "wordless", "signs", "echoes", "monotony", "pairs", "prose")
GOOD, NONE, JUNK = 2, 1, 0  # votes

_KIND = np.zeros(256, np.int64)  # 0 other, then: blank, capital, small letter or part of a non-ASCII one, digit, end mark, '!', symbol
_KIND[[0x20, *range(9, 14)]] = 1
_KIND[65:91] = 2
_KIND[97:123] = 3
_KIND[128:] = 3
_KIND[48:58] = 4
_KIND[[ord(c) for c in ".?,;:"]] = 5
_KIND[ord("!")] = 6
_KIND[[ord(c) for c in "#$%&*+<=>@\\^_`{|}~"]] = 7


def votes(b: np.ndarray) -> list[int]:
    """One vote per labeller on a text's bytes; too little text: none."""
    kinds = _KIND[b]
    count = np.bincount(kinds, minlength=8)
    solid = len(b) - int(count[1])
    if solid < 20:
        return [NONE] * len(LABELLERS)
    blank = kinds == 1
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    words = len(starts)
    letter = np.cumsum(np.r_[0, (kinds >= 2) & (kinds <= 4)])
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    letters = int(count[2] + count[3])

    def junk(value: float, limit: float) -> int:
        return JUNK if value >= limit else NONE

    echoes, top, pairs = _repeated(b) if words >= 8 else (0.0, 0.0, 0.0)
    marks = words / max(int(count[5]), 1)
    return [
        junk(count[7] / solid, 0.04),
        junk(count[2] / max(letters, 1), 0.5),
        junk(count[6] / words, 0.3),
        junk(float((letter[ends] == letter[starts]).mean()), 0.25),
        junk(1 - (letters + count[4]) / solid, 0.14),
        junk(echoes, 0.3),
        junk(top, 0.3),
        junk(pairs, 0.6),
        NONE if words < 30 else GOOD if 2 < marks <= 60 and top <= 0.2 and echoes <= 0.1 else junk(marks, 200),
    ]


def _repeated(b: np.ndarray) -> tuple[float, float, float]:
    """Share of words equal to the word before them, of the commonest word, and of repeated word pairs.

    Taken in stretches of text, since words of a long text repeat by nature.
    """
    same = top = pairs = total = 0
    for at in range(0, len(b), STRETCH):
        part = b[at : at + STRETCH]
        h, _ = word_hashes(part, np.array([0, len(part)]))
        total += len(h)
        if len(h) > 1:
            same += int((h[1:] == h[:-1]).sum())
            top += int(np.unique(h, return_counts=True)[1].max())
            pairs += len(h) - 1 - len(np.unique(h[1:] * np.uint64(3) + h[:-1]))
    return same / max(total, 1), top / max(total, 1), pairs / max(total, 1)


def features(b: np.ndarray, said: list[int], size: int = FEATURES) -> np.ndarray:
    """Hashed byte trigrams and votes of a text: roots of shares, which stay small for a short text."""
    counts = np.zeros(size)
    shift = np.uint32(32 - (size - 1).bit_length())
    for at in range(0, max(len(b) - 2, 0), BLOCK):
        x = b[at : at + BLOCK + 2].astype(np.uint32)
        code = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)
        counts += np.bincount(code >> shift, minlength=size)
    out = np.sqrt(counts / (counts.sum() + 64))
    told = np.array([k * 3 + v for k, v in enumerate(said) if v != NONE], np.uint32) + np.uint32(1 << 24)
    np.add.at(out, told * np.uint32(2654435761) >> shift, 0.25)
    return out


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Posterior probability of good for each combination of votes.

    Each labeller that votes is right with an accuracy of its own, whatever the class, and
    independently of the others; silence says nothing. Accuracies start at 0.9, and the share
    of good texts at one half; both are estimated in turn with the posteriors.
    """
    counts = counts.astype(float)
    side = (patterns == GOOD) * 1.0 - (patterns == JUNK)
    accuracy, prior = np.full(patterns.shape[1], 0.9), 0.5
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        score = np.log(prior / (1 - prior)) + side @ np.log(accuracy / (1 - accuracy))
        new = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        done = np.abs(new - post).max(initial=0) < 1e-9
        post = new
        right = counts @ ((side > 0) * post[:, None] + (side < 0) * (1 - post[:, None]))
        accuracy = (right + 9) / (counts @ np.abs(side) + 10)
        prior = (counts @ post + 1) / (counts.sum() + 2)
        if done:
            break
    return post


def fit_scorer(x: np.ndarray, target: np.ndarray, steps: int = 300, keep: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on probabilities by accelerated descent; ``x`` stays in single precision."""
    w, bias = np.zeros(x.shape[1]), 0.0
    ahead_w, ahead_b, rate = w, bias, 4.0
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip((x @ ahead_w.astype(x.dtype)).astype(np.float64) + ahead_b, -500, 500)))
        error = (p - target) / len(x)
        new_w, new_b = ahead_w - rate * ((error.astype(x.dtype) @ x).astype(np.float64) + keep * ahead_w), ahead_b - rate * error.sum()
        step = t / (t + 3)
        ahead_w, ahead_b = new_w + step * (new_w - w), new_b + step * (new_b - bias)
        w, bias = new_w, new_b
    return w, bias


def _vote_rows(batches):
    for batch in batches:
        flat, cuts = texts_of(batch.column("text"))
        codes = [_code(votes(flat[cuts[r] : cuts[r + 1]])) for r in range(len(cuts) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column("rank"), pa.array(codes, pa.int64())], ["rank", "votes"])


def _code(said: list[int]) -> int:
    return int("".join(map(str, said)), 3)


def _feature_rows(batches):
    """Votes and features of the texts of a task, those of equal rank once."""
    seen = set()
    for batch in batches:
        flat, cuts = texts_of(batch.column("text"))
        ranks, codes, data = [], [], []
        for r, rank in enumerate(batch.column("rank").to_pylist()):
            if rank in seen:
                continue
            seen.add(rank)
            b = flat[cuts[r] : cuts[r + 1]]
            said = votes(b)
            ranks.append(rank)
            codes.append(_code(said))
            data.append(features(b, said).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(codes, pa.int64()), pa.array(data, pa.binary())], ["rank", "votes", "features"])


def _scorer(weights: np.ndarray, bias: float, columns: list[str], text: str):
    def run(batches):
        for batch in batches:
            flat, cuts = texts_of(batch.column(text).cast(pa.string()))
            scores = []
            for r in range(len(cuts) - 1):
                b = flat[cuts[r] : cuts[r + 1]]
                # too short for a trigram: nothing speaks against it
                scores.append(1.0 if len(b) < 3 else float(1 / (1 + np.exp(-np.clip(features(b, votes(b)) @ weights + bias, -500, 500)))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(scores, pa.float64())], [*columns, "_quality"])

    return run


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """``carry`` columns (default: the id) and ``_quality``, the probability that a text is good.

    Every text is scored as a whole. Labellers and scorer look at bytes only, so languages do
    not matter. Texts of fewer than 3 bytes, NULL included, score 1: nothing speaks against
    them. The sample is the ``sample`` texts of smallest hash, a text that many rows hold
    counting once. The same rows give the same scores. No rows: no rows.
    """
    carry = [id_col] if carry is None else carry
    rows = docs.select(F.xxhash64(F.lit(5), F.col(text_col)).alias("rank"), F.col(text_col).cast("string").alias("text"))
    voted = saved(rows.mapInArrow(trimmed(_vote_rows), "rank long, votes long"), "quality-votes")
    found = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()  # at most 3 ** labellers
    codes = np.array([r["votes"] for r in found], np.int64)
    patterns = np.stack([codes // 3 ** (len(LABELLERS) - 1 - k) % 3 for k in range(len(LABELLERS))], axis=1).astype(np.int64)
    post = dict(zip(codes.tolist(), fit_votes(patterns, np.array([r["n"] for r in found])), strict=True)) if found else {}
    cut = voted.select("rank").distinct().orderBy("rank").limit(sample).agg(F.max("rank")).first()[0]
    weights, bias = np.zeros(FEATURES), 10.0
    if cut is not None:
        fitted = rows.where(F.col("rank") <= cut).mapInArrow(trimmed(_feature_rows), "rank long, votes long, features binary")
        # one row for each rank, in order; sums must not depend on the order of arrival
        fitted = saved(fitted.groupBy("rank").agg(F.min(F.struct("votes", "features")).alias("x")).select("rank", "x.*"), "quality-sample")
        x, target = np.zeros((sample, FEATURES), np.float32), []
        for r, row in enumerate(fitted.orderBy("rank").toLocalIterator()):
            x[r] = np.frombuffer(row["features"], np.float32)
            target.append(post[row["votes"]])
        weights, bias = fit_scorer(x[: len(target)], np.array(target))
    # the text goes to Python once, also when it is carried
    at = carry.index(text_col) if text_col in carry else len(carry)
    out = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], *([F.col(text_col).alias(f"_c{at}")] if at == len(carry) else []))
    names = [f"_c{i}" for i in range(len(carry))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, carry, strict=True))
    scored = out.mapInArrow(trimmed(_scorer(weights, bias, names, f"_c{at}")), f"{schema}, _quality double")
    return scored.select(*[F.col(n).alias(c) for n, c in zip(names, carry, strict=True)], "_quality")
