"""Hashes of words and of word sequences for many texts at once, in numpy.

A polynomial over the bytes, taken from prefix sums modulo 2 ** 64 and then mixed, gives every
word its hash without a loop; the same over word hashes gives every sequence of n words one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BYTES_AT_ONCE = 1 << 18
_BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers of an odd number modulo 2 ** 64, at least n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BYTES_AT_ONCE + 2), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def spans_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values) + 1)[: len(values)], out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    back = _power(inverse, len(values) + 1)[starts]
    return mixed((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64))


def chunks(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in stretches of about BYTES_AT_ONCE, with the number of the first."""
    part: list[bytes] = []
    first, size = 0, 0
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if part and size + len(raw) > BYTES_AT_ONCE:
            yield first, part
            part, first, size = [], i, 0
        part.append(raw)
        size += len(raw)
    if part:
        yield first, part


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (one more entry than texts)."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    white = _WHITE[joined]
    before = np.concatenate([[True], white[:-1]])
    starts = np.flatnonzero(~white & before)
    ends = np.flatnonzero(white & ~before)
    values = (_LOWER[joined] if lower else joined).astype(np.uint64) + np.uint64(1)
    firsts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    return spans_hashes(values, starts, ends, _BYTE_BASE), firsts


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for the n words from each place on; empty if there are fewer."""
    starts = np.arange(max(0, len(words) - n + 1))
    return spans_hashes(words, starts, starts + n, WORD_BASE)
