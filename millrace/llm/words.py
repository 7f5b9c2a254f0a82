"""Hashes of the words and word shingles of many texts at once, on their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 2 << 20  # bytes of text hashed at once; longer texts are cut between words
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
# all ASCII but digits and letters
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 … base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK + 1), base & (2**64 - 1), np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def word_hashes(b: np.ndarray, cuts: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in bytes ``b``, and the number of words of each text.

    ``cuts`` are the ends of the texts in ``b`` with a 0 before them; ``blank`` marks the bytes
    between words.
    """
    n = len(b)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(cuts) - 1, np.int64)
    word = ~blank[b]
    edge = np.zeros(n + 1, bool)
    edge[cuts] = True
    prev = np.empty(n, bool)
    prev[0], prev[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~prev | edge[:n]))
    following = np.empty(n, bool)
    following[-1], following[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~following | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[b] * powers(_BASE, n), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_INVERSE, n)[starts]
    h = mix(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, np.diff(np.searchsorted(starts, cuts))


def _parts(b: np.ndarray, blank: np.ndarray = _BLANK):
    """Word hashes of one text of any length, block by block."""
    at = 0
    while at < len(b):
        end = min(len(b), at + BLOCK)
        while end < len(b):
            gaps = np.flatnonzero(blank[b[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(b), end + BLOCK)
        yield word_hashes(b[at:end], np.array([0, end - at]), blank)[0]
        at = end


def _long(b: np.ndarray) -> np.ndarray:
    return np.concatenate(list(_parts(b)))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text ends (with a first 0) of a string column; NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    cuts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return flat[cuts[0] : cuts[-1]], cuts - cuts[0]


def blocks(cuts: np.ndarray):
    """Runs of whole texts of about BLOCK bytes: (first text, end text)."""
    at = 0
    while at < len(cuts) - 1:
        end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + BLOCK, "right")) - 1)
        yield at, end
        at = end


def word_blocks(column: pa.Array, blank: np.ndarray):
    """(first text, word hashes, words of each text) for blocks of whole texts.

    A text longer than a block comes alone, in several blocks with the same first text.
    """
    flat, cuts = texts_of(column)
    for at, end in blocks(cuts):
        b = flat[cuts[at] : cuts[end]]
        if end == at + 1 and len(b) > BLOCK:
            for h in _parts(b, blank):
                yield at, h, np.array([len(h)])
        else:
            yield at, *word_hashes(b, cuts[at : end + 1] - cuts[at], blank)


def _combine(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return out


def shingle_sets(column: pa.Array, size: int):
    """For each text, its sorted distinct shingles of ``size`` words as 64-bit hashes.

    Fewer words: one shingle of all of them. No word: none.
    """
    flat, cuts = texts_of(column)
    for at, end in blocks(cuts):
        b = flat[cuts[at] : cuts[end]]
        if end == at + 1 and len(b) > BLOCK:
            h = _long(b)
            counts = np.array([len(h)])
        else:
            h, counts = word_hashes(b, cuts[at : end + 1] - cuts[at])
        runs = _combine(h, size) if len(h) >= size else np.zeros(0, np.uint64)
        first = 0
        for n in counts.tolist():
            if n >= size:
                yield np.unique(runs[first : first + n - size + 1])
            else:
                yield _combine(h[first : first + n], n) if n else np.zeros(0, np.uint64)
            first += n
