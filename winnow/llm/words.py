"""Words of whole texts as 64-bit hashes, one numpy pass over a batch.

A word is a maximal run of bytes other than blank and 0x09-0x0D, with A-Z
lower-cased, exactly as the query contracts state it. Texts of a batch are laid
end to end as UTF-8 bytes; a word's hash is a polynomial over a fixed random
byte table, taken from one running sum, so the cost is a few vector operations
a byte and no Python loop over words. Two different words collide with the
chance of two random 64-bit numbers.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20_240_501))
_BYTE = _RNG.integers(1, 2**64 - 1, 256, dtype=np.uint64)
EXACT = _BYTE.copy()  # a number for every byte
_BYTE[65:91] = _BYTE[97:123]  # the same with A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_LETTER = np.ones(256, bool)  # every byte but A-Z, a-z and those of non-ASCII characters
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1 << 16  # bytes worked on at once: the temporaries stay in the cache


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        p, q = np.full(size, _P), np.full(size, _P_INV)
        p[0] = q[0] = 1
        _POWERS, _INVERSES = np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
    return _POWERS, _INVERSES


def word_bounds(buf: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every maximal run of bytes outside ``gap``."""
    space = np.empty(len(buf) + 2, bool)
    space[0] = space[-1] = True
    np.take(gap, buf, out=space[1:-1])
    turn = np.flatnonzero(space[1:] != space[:-1])
    return turn[0::2], turn[1::2]


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hash of each byte span [start, end); spans in rising order."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        lo = int(start[i])
        j = int(np.searchsorted(end, lo + CHUNK, "right"))
        j = max(j, i + 1)
        hi = int(end[j - 1])
        p, q = _powers(hi - lo + 1)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[buf[lo:hi]] * p[: hi - lo], out=run[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (run[e] - run[s]) * q[s]
        i = j
    return mix64(out + (end - start).astype(np.uint64))


def joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the texts, each closed by a newline; end of each text)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    return buf, np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))


def batch_words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, word start, word end, word hash, first word of each text) of a
    batch of texts (str or None); text i has words[first[i]:first[i + 1]]."""
    buf, ends = joined(texts)
    start, end = word_bounds(buf)
    first = np.concatenate([[0], np.searchsorted(start, ends, "left")])
    return buf, start, end, hash_spans(buf, start, end), first


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words of one text (fewer words: the whole
    sequence as one; none: empty)."""
    if not len(words):
        return words
    k = min(n, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out += words[i : len(words) - k + 1 + i] * _MIX[i]
    return mix64(out + np.uint64(k))
