"""Words and word n-grams of Arrow text columns as 64-bit hashes, in numpy.

A word's hash is a polynomial over its bytes modulo 2**64, taken from running sums; a second base
gives an independent hash. Work goes in blocks of about a megabyte, so a very long text needs no more
memory than its hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BLOCK = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd(n: int, seed: int = 0) -> np.ndarray:
    """n fixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, BLOCK + 1)
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            t = np.full(size, b, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        got = _POWERS[base] = (tables[0], tables[1])
    return got


class Words:
    """The words of a column of texts: byte ``starts`` and ``ends`` in ``data``; words of text i are ``first[i]:first[i + 1]``.
    ``blank`` says of each byte whether it stands between words; ``lower`` takes A-Z as a-z."""

    def __init__(self, column: pa.Array, blank: np.ndarray = _BLANK, lower: bool = False):
        if pa.types.is_large_string(column.type):
            column = column.cast(pa.string())
        _, offsets, data = column.buffers()
        n = len(column)
        off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        lo, hi = int(off[0]), int(off[-1])
        self.data = np.frombuffer(data, np.uint8)[lo:hi] if data is not None else np.zeros(0, np.uint8)
        if lower:
            self.data = self.data + ((self.data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
        off = off - lo
        letter = ~blank[self.data]
        begins, stops = letter.copy(), letter.copy()
        begins[1:] &= ~letter[:-1]
        stops[:-1] &= ~letter[1:]
        edges = off[(off > 0) & (off < len(letter))]          # a text's end ends its last word
        begins[edges] = letter[edges]
        stops[edges - 1] = letter[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, off)
        self.text_of = np.repeat(np.arange(n), np.diff(self.first))

    def hashes(self, which: int = 0) -> np.ndarray:
        base, out, at, n = BASES[which], np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        while at < n:
            lo = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, lo + BLOCK, "right")))
            s, e = self.starts[at:to] - lo, self.ends[at:to] - lo
            power, inverse = _powers(base, int(e[-1]) + 1)
            sums = np.zeros(e[-1] + 1, np.uint64)
            np.cumsum((self.data[lo:lo + e[-1]].astype(np.uint64) + np.uint64(1)) * power[:e[-1]], out=sums[1:])
            out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
            at = to
        return out

    def grams(self, hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
        """Hash of the n words from each position; only positions of ``whole(n)`` are meaningful."""
        m = max(0, len(hashes) - n + 1)
        out = np.zeros(m, np.uint64)
        for j, k in enumerate(odd(n, seed)):
            out += hashes[j:j + m] * k
        return mix(out)

    def whole(self, n: int) -> np.ndarray:
        """Positions at which n words of one text begin."""
        m = max(0, len(self.text_of) - n + 1)
        return np.flatnonzero(self.text_of[:m] == self.text_of[n - 1:n - 1 + m])
