"""Words of many texts at once, as numpy arrays over their UTF-8 bytes; hashes of words and of word shingles.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. These are single bytes in UTF-8, so
byte runs and code point runs are the same. Hashes are 64 bits wide, depend on nothing but the bytes, and are the
same on every machine. Work is done in slices of a few MB, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD1342543DE82EF95 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    held = _powers.get(int(base))
    if held is not None and n <= len(held):
        return held[:n]
    m = n if n > SLICE_BYTES else 1 << max(10, (n - 1).bit_length())
    made = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, base)]), dtype=np.uint64)
    if n <= SLICE_BYTES:  # those of a very long text are not kept
        _powers[int(base)] = made
    return made[:n]


def _hashes(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Hash of each run of `lens` of the bytes' numbers, which are lost: the sum of number times power of the place in the run.

    The powers of the place among all bytes are multiplied in and, modulo 2^64, divided out of each run's sum.
    """
    sums = np.zeros(len(lens), np.uint64)
    full = lens > 0
    if len(values):
        first = (np.cumsum(lens) - lens)[full]
        values *= powers(len(values))
        sums[full] = np.add.reduceat(values, first) * powers(len(values), _INVERSE)[first]
    return mix(sums + lens.astype(np.uint64) * _STEP)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hash of each byte run [start, end); runs ascend and do not overlap. `fold` lower-cases A-Z first."""
    lens = ends - starts
    if not len(lens):
        return np.empty(0, np.uint64)
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum())) + np.repeat(starts - first, lens)
    return _hashes((_FOLDED if fold else _BYTES)[data[at]], lens)


class Words:
    """Words of the texts `data[offsets[i]:offsets[i + 1]]`: starts, ends (bytes), doc (index of the text), hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool = False):
        self.data, self.offsets = data, offsets
        inside = ~WHITE[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        cut = offsets[:-1][offsets[:-1] < len(data)]
        opens[cut] = inside[cut]  # a text starts a new word even where the one before ends in a word
        closes = np.zeros(len(data) + 1, bool)
        closes[1:] = inside
        closes[:-1] &= ~inside | opens
        closes[0] = False
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes)
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i]:bounds[i + 1]
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.hash = _hashes((_FOLDED if fold else _BYTES)[data[inside]], self.ends - self.starts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k-word windows, text by text, and their bounds. A text of 1 to k-1 words gives one of all its words."""
        n, w = len(self.hash), self.hash
        per_text = np.where(self.counts >= k, self.counts - k + 1, (self.counts > 0).astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        first = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - self.bounds[:-1], per_text)
        out = np.full(max(n - k + 1, 0), np.uint64(k * int(_STEP) % (1 << 64)))  # of the k words from each word on, those of two texts too
        for j in range(k):
            out *= _BASE
            out += w[j : j + len(out)]
        short = np.flatnonzero((self.counts > 0) & (self.counts < k))
        if not len(short):
            return mix(out[first]), bounds
        out = out[np.minimum(first, len(out) - 1)] if len(out) else np.zeros(len(first), np.uint64)
        length, at = self.counts[short], self.bounds[:-1][short]
        whole = length.astype(np.uint64) * _STEP
        for j in range(k):
            whole = whole * _BASE + np.where(j < length, w[np.minimum(at + j, n - 1)], np.uint64(0))
        out[bounds[:-1][short]] = whole
        return mix(out), bounds


def from_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [b"" if t is None else t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of a text column, each at most `limit` bytes or one text. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def code_points(data: np.ndarray) -> np.ndarray:
    """True at each byte that starts a code point."""
    return (data & 0xC0) != 0x80
