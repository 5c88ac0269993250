"""Array hashing shared by the text operators: bytes, windows, words and shingles of many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}
#: Powers that a worker keeps (8 MB a table); longer ones are made when they are asked for.
KEEP = 1 << 20


def _powers(n: int, base: np.uint64, name: str) -> np.ndarray:
    have = _POW.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = np.empty(size, np.uint64)
        out[0] = 1
        done = 1
        while done < size:  # doubling: base**(done + i) = base**done * base**i
            step = np.uint64(pow(int(base), done, 1 << 64))
            out[done:2 * done] = out[:done] * step
            done *= 2
        have = out
        if size <= KEEP:
            _POW[name] = out
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Prefix:
    """Prefix sums of a byte string, from which the hash of any stretch follows."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(n, _BASE, "up"), out=self.sums[1:])

    def hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Mixed hashes of the stretches ``[lo, hi)``."""
        down = _powers(len(self.sums), _INV, "down")
        return mix((self.sums[hi] - self.sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, k: int) -> np.ndarray:
        """Mixed hashes of all stretches of ``k`` bytes."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * _powers(n, _INV, "down"))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after the other, and where each text's words start.

    Words are runs of bytes other than space and 9 to 13; A-Z count as a-z.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        raw = _LOWER[raw]
    gap = _SPACE[raw]
    first = ~gap
    first[1:] &= gap[:-1]
    last = ~gap
    last[:-1] &= gap[1:]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return Prefix(raw).hash(lo, hi), np.searchsorted(lo, starts)


#: Cells that words are dealt to by the top bits of their hashes, for the weights of ``shingle_sets``.
CELL_BITS = 22
#: Bits of a hash below its class, classes (the last one is left free), and the largest weight of a word.
LOW_BITS, CLASSES, HEAVIEST = 58, 32, 19


def cells(words: np.ndarray) -> np.ndarray:
    """The cell of each word hash."""
    return (words >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _classed(h: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Hashes below five bits of class: 0 for the largest weights, ``CLASSES`` - 2 for the smallest."""
    last = CLASSES - 2
    kind = last - np.minimum(weight.astype(np.int64) * (last + 1) // (HEAVIEST * k), last)
    return (kind.astype(np.uint64) << np.uint64(LOW_BITS)) | (h >> np.uint64(64 - LOW_BITS))


def shingle_sets(texts: list[bytes], k: int, weights: np.ndarray | None = None,
                 words: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``k``-word shingles; with fewer words, of them all as one.

    With ``weights`` (at most ``HEAVIEST`` for each cell of words, more for rarer words) hashes
    are ``LOW_BITS`` long, and a class above them puts shingles of rare words first.  ``words``
    are the texts' word hashes, if they are known.
    """
    words, at = word_hashes(texts) if words is None else words
    n = len(words)
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i:n - k + 1 + i])
        if weights is not None:
            each = weights[cells(words)].astype(np.uint16)
            h = _classed(h, sum(each[i:n - k + 1 + i] for i in range(k)), k)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= k:
            out.append(np.unique(h[lo:hi - k + 1]))
        elif hi > lo:
            x = np.asarray([hi - lo], np.uint64)
            for i in range(lo, hi):
                x = mix(x * np.uint64(0xD6E8FEB86659FD93) + words[i:i + 1])
            out.append(x if weights is None else _classed(x, np.full(1, HEAVIEST * k), k))
        else:
            out.append(np.empty(0, np.uint64))
    return out
