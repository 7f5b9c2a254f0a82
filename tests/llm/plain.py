"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Sets:
    """Disjoint sets of comparable names."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, size):
    words = WORD.findall((text or "").encode().translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_duplicates(docs, size, percent):
    """docs: (id, text) with distinct ids. {id: (set size, component)}"""
    sets = {i: shingles(t, size) for i, t in docs}
    joined, holders = Sets(), defaultdict(list)
    for i, s in sets.items():
        joined.find(i)
        for x in s:
            holders[x].append(i)
    pairs = Counter()
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                pairs[a, b] += 1
    for (a, b), both in pairs.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            joined.join(a, b)
    return {i: (len(s), joined.find(i)) for i, s in sets.items()}


def repeats(docs, span, keep_first=False):
    """docs: (id, text) in order. {id: (bytes, removed, spans, hash of the rest)}"""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter()
    for _, b in data:
        for s in range(len(b) - span + 1):
            seen[b[s : s + span]] += 1
    out, met = {}, set()
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - span + 1):
            x = b[s : s + span]
            if seen[x] > 1 and (not keep_first or x in met):
                gone[s : s + span] = True
            met.add(x)
        gone[-1] = False
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_vectors(rows, cosine):
    """rows: (id, vector). {id: (links, component)}"""
    ok = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    joined, links = Sets(), Counter()
    for i, _ in rows:
        joined.find(i)
    m = np.array([v / np.linalg.norm(v) for _, v in ok])
    if len(ok):
        close = np.argwhere(np.triu(m @ m.T >= cosine, 1))
        for a, b in close:
            links[ok[a][0]] += 1
            links[ok[b][0]] += 1
            joined.join(ok[a][0], ok[b][0])
    return {i: (links[i], joined.find(i)) for i, _ in rows}


def top_k(rows, k, every, scale=64):
    """rows: (id, vector) with distinct ids. {(query, rank): (id, score)}"""
    ok = [(i, np.floor(np.array(v, np.float64) * scale).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in ok:
        if q % every == 0:
            scores = sorted((-int(v @ w), i) for i, w in ok if i != q and len(w) == len(v))
            out.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(scores[:k])})
    return out


def targets(sizes, share=1.5, weights=(3, 1, 2), most=2.0):
    """sizes: {source: words}. Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = budget - sum(most * sizes[s] for s in full)
        goal = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if goal[s] >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else goal[s] for s in order}
        full |= over


def weak_labels(rows, good=2, junk=0, rounds=500):
    """rows: one vote per labeller. Posterior of good for each row, by the same model taken row by row."""
    labellers = range(len(rows[0]))
    accuracy, prior, post = [0.9] * len(rows[0]), 0.5, [0.0] * len(rows)
    for _ in range(rounds):
        new = []
        for votes in rows:
            yes, no = prior, 1 - prior
            for k in labellers:
                if votes[k] == good:
                    yes, no = yes * accuracy[k], no * (1 - accuracy[k])
                elif votes[k] == junk:
                    yes, no = yes * (1 - accuracy[k]), no * accuracy[k]
            new.append(yes / (yes + no))
        done = max(abs(a - b) for a, b in zip(new, post, strict=True)) < 1e-9
        post = new
        for k in labellers:
            right = sum(p if v[k] == good else 1 - p for v, p in zip(rows, post, strict=True) if v[k] in (good, junk))
            accuracy[k] = (right + 9) / (sum(v[k] in (good, junk) for v in rows) + 10)
        prior = (sum(post) + 1) / (len(rows) + 2)
        if done:
            break
    return post


def trigram_features(text, votes, size=4096, none=1):
    """Roots of shares of hashed trigrams, and the votes, one by one."""
    b, counts = (text or "").encode(), Counter()
    bits = size.bit_length() - 1
    cell = lambda code: (code * 2654435761 % 2**32) >> (32 - bits)
    for i in range(len(b) - 2):
        counts[cell(b[i] << 16 | b[i + 1] << 8 | b[i + 2])] += 1
    total = sum(counts.values())
    out = np.zeros(size)
    for c, n in counts.items():
        out[c] = np.sqrt(n / (total + 64))
    for k, v in enumerate(votes):
        if v != none:
            out[cell(k * 3 + v + (1 << 24))] += 0.25
    return out


def logistic(x, target, keep=1e-5):
    """The minimum of the scorer's loss, by Newton steps in the rows' space."""
    n = len(x)
    k, bias, alpha = x @ x.T, 0.0, np.zeros(n)
    for _ in range(100):
        p = 1 / (1 + np.exp(-(k @ alpha + bias)))
        w = np.maximum(p * (1 - p), 1e-12)
        # stationary: alpha = (target - p) / (n keep), and the errors sum to 0
        system = np.zeros((n + 1, n + 1))
        system[:n, :n], system[:n, n], system[n, :n] = k * w[:, None] + n * keep * np.eye(n), w, w @ k
        system[n, n] = w.sum()
        step = np.linalg.solve(system, np.r_[target - p - n * keep * alpha, (target - p).sum()])
        alpha, bias = alpha + step[:n], bias + step[n]
        if np.abs(step).max() < 1e-10:
            break
    return x.T @ alpha, bias


def tilt(sizes, target, most=2.0):
    """Multiplier of one source by bisection: words at rates most / (1 + exp(-t x)) reach the target."""
    mean = sum(sizes) / len(sizes)
    low, high = -1024.0, 1024.0
    for _ in range(200):
        t = (low + high) / 2
        got = sum(most * s / (1 + np.exp(-t * s / mean)) for s in sizes)
        low, high = (t, high) if got < target else (low, t)
    return t
