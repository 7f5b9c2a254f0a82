"""FM-index of a shard of texts over the hashes of their words.

The texts stand one behind the other, each closed by an end mark. All suffixes are sorted;
the symbols before them, in that order, make the transform, kept as a wavelet matrix of bit
planes. Ranks in it step a phrase's range of suffixes one word to the left (backward search),
and step a suffix to the one a word before it, until a sampled position is met (locate).
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8  # every so many positions of the shard is sampled, and every start of a text


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling; end marks are distinct, so ties end with their text."""
    n, width = len(symbols), 21
    key = symbols.astype(np.uint64)
    depth = 1
    if int(symbols.max()) < 1 << width:
        for step in (1, 2):
            key <<= np.uint64(width)
            key[: n - step] |= symbols[step:].astype(np.uint64)
        depth = 3
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.r_[True, key[1:] != key[:-1]]
    first = np.flatnonzero(head)
    rank = np.empty(n, np.int64)
    rank[order] = first[np.cumsum(head) - 1]
    tied = np.flatnonzero(~(head & np.r_[head[1:], True]))
    while len(tied):
        at = order[tied]
        key = rank[at] * n + rank[np.minimum(at + depth, n - 1)]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        head = np.r_[True, key[1:] != key[:-1]]
        first = tied[np.flatnonzero(head)]
        rank[at] = first[np.cumsum(head) - 1]
        tied = tied[~(head & np.r_[head[1:], True])]
        depth *= 2
    return order


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, with one word more, so that ranks at the end need no test."""
    out = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
    small = np.packbits(bits, bitorder="little")
    out[: len(small)] = small
    return out.view("<u8")


def build(hashes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """The index of texts with ``counts`` words each, whose word hashes follow each other in ``hashes``."""
    texts = len(counts)
    words, symbol = np.unique(hashes, return_inverse=True)
    ends = np.cumsum(counts + 1)
    starts = ends - counts - 1
    n = len(hashes) + texts
    is_word = np.ones(n, bool)
    is_word[ends - 1] = False
    # end marks are 0 … texts - 1 while sorting, and all 0 in the transform
    distinct = np.empty(n, np.int64)
    distinct[is_word], distinct[~is_word] = symbol + texts, np.arange(texts)
    order = _suffix_order(distinct)
    sequence = np.where(distinct < texts, 0, distinct - texts + 1).astype(np.int32)
    before = sequence[order - 1]  # the first suffix is a text's start: never stepped over
    levels = max(1, int(len(words)).bit_length())
    planes = np.empty((levels, n // 64 + 1), np.uint64)
    zeros = np.empty(levels, np.int64)
    for level in range(levels):
        bit = (before >> (levels - 1 - level)) & 1 == 1
        planes[level] = _packed(bit)
        before = np.r_[before[~bit], before[bit]]
        zeros[level] = n - np.count_nonzero(bit)
    # from a symbol's place in the last level to its place among the sorted suffixes
    last = np.empty(len(words) + 1, np.int64)
    fresh = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
    last[before[fresh]] = fresh
    ahead = np.r_[0, np.cumsum(np.bincount(sequence, minlength=len(words) + 1))[:-1]]
    start = np.zeros(n, bool)
    start[starts] = True
    sampled = (order % SAMPLE == 0) | start[order]
    return {
        "words": words, "starts": starts.astype(np.int32), "planes": planes.ravel(), "zeros": zeros, "delta": (ahead - last).astype(np.int32),
        "marks": _packed(sampled), "samples": order[sampled].astype(np.int32),
    }


class Index:
    """An index read back, with the counts of ones that its ranks need."""

    def __init__(self, parts: dict[str, np.ndarray], n: int):
        self.n, self.words, self.starts = n, parts["words"], parts["starts"]
        self.zeros, self.delta, self.samples = parts["zeros"], parts["delta"], parts["samples"]
        self.planes = parts["planes"].reshape(len(self.zeros), -1)
        self.ones = [self._before(p) for p in self.planes]
        self.marks, self.marked = parts["marks"], self._before(parts["marks"])

    @staticmethod
    def _before(plane: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(plane).astype(np.int64)
        return np.cumsum(ones) - ones

    @staticmethod
    def _rank(plane: np.ndarray, ones: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        word, low = i >> 6, (i & 63).astype(np.uint64)
        return ones[word] + np.bitwise_count(plane[word] & ((np.uint64(1) << low) - np.uint64(1)))

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """First place, among the sorted suffixes, of those that ``symbol`` makes of the suffixes from place i on."""
        for level, plane in enumerate(self.planes):
            one = (symbol >> (len(self.zeros) - 1 - level)) & 1 == 1
            rank = self._rank(plane, self.ones[level], i)
            i = np.where(one, self.zeros[level] + rank, i - rank)
        return i + self.delta[symbol]

    def back(self, i: np.ndarray) -> np.ndarray:
        """Place of the suffix that starts one word before the one at place i."""
        symbol = np.zeros(len(i), np.int64)
        for level, plane in enumerate(self.planes):
            one = (plane[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1
            rank = self._rank(plane, self.ones[level], i)
            i = np.where(one, self.zeros[level] + rank, i - rank)
            symbol = symbol << 1 | one
        return i + self.delta[symbol]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, as rows of ``symbols`` (their words, from the left), and their ranges of places."""
        which = np.flatnonzero(lengths > 0)
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.n, np.int64)
        done = [(which[:0],) * 3]
        at = 1
        while len(which):
            symbol = symbols[which, lengths[which] - at]
            low, high = self.step(symbol, low), self.step(symbol, high)
            full = (lengths[which] == at) & (low < high)
            done.append((which[full], low[full], high[full]))
            more = (lengths[which] > at) & (low < high)
            which, low, high = which[more], low[more], high[more]
            at += 1
        which, low, high = (np.concatenate(x) for x in zip(*done, strict=True))
        return which, low, high

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Positions in the shard of the suffixes at places i."""
        out = np.zeros(len(i), np.int64)
        left, steps = np.arange(len(i)), 0
        while len(left):
            here = (self.marks[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1
            out[left[here]] = self.samples[self._rank(self.marks, self.marked, i[here])] + steps
            left, i, steps = left[~here], i[~here], steps + 1
            if len(left):
                i = self.back(i)
        return out
