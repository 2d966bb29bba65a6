"""Vectorised text primitives shared by the word-based operators.

Everything works on the raw UTF-8 buffers of an Arrow string column, a bounded slice of
rows at a time, so that no Python loop runs over words.  A *word* is a maximal run of
bytes other than space and the five ASCII controls 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_LONG = 255

with np.errstate(over="ignore"):
    _rng = np.random.Generator(np.random.PCG64(20240607))
    _BYTE = _rng.integers(0, 2**64, 256, dtype=U64) | U64(1)
    _POW = np.cumprod(np.full(_LONG + 1, 0x9E3779B97F4A7C15, dtype=U64), dtype=U64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: a bijection that spreads every bit over the word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its row offsets; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def lists(col) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a list column without nulls (which may be a slice)."""
    off = col.offsets.to_numpy()
    return col.flatten().to_numpy(zero_copy_only=False), off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into row ranges of at most ``most`` text bytes (one row at least)."""
    col = batch.column(column)
    if len(col) == 0:
        return
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    edges = [0, *cuts.tolist(), len(col)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


class Words:
    """Words of the rows of a string column.

    ``hash`` one 64-bit hash a word, ``start``/``end`` byte ranges in ``data``, ``first``
    the index of each row's first word (with one more entry for the end).
    """

    __slots__ = ("data", "end", "first", "hash", "start")

    def __init__(self, col, lower: bool = False):
        data, off = utf8(col)
        self.data = data
        if lower:
            data = LOWER[data]
        letter = ~_SPACE[data]
        begin = letter.copy()
        if len(data):
            row = np.zeros(len(data) + 1, dtype=bool)
            row[off] = True
            begin[1:] &= ~letter[:-1] | row[1:-1]
        self.start = np.flatnonzero(begin)
        n = len(self.start)
        self.first = np.searchsorted(self.start, off)
        if not n:
            self.end, self.hash = self.start, np.zeros(0, U64)
            return
        # a word ends at the next space or at the end of its row
        stop = np.ones(len(data) + 1, dtype=bool)
        stop[:-1] = ~letter
        stop[off] = True
        stops = np.flatnonzero(stop)
        self.end = stops[np.searchsorted(stops, self.start, side="right")]
        span = np.diff(np.append(self.start, len(data)))
        at = np.arange(len(data), dtype=np.int64)
        at[self.start[0] :] -= np.repeat(self.start, span)
        with np.errstate(over="ignore"):
            part = _BYTE[data] * _POW[np.minimum(at, _LONG)]
            part[~letter] = 0
            size = (self.end - self.start).astype(U64)
            got = mix(np.add.reduceat(part, self.start) + size * U64(0xD6E8FEB86659FD93))
        for i in np.flatnonzero(size > _LONG):
            got[i] = xxhash.xxh3_64_intdigest(data[self.start[i] : self.end[i]].tobytes(), 77)
        self.hash = got

    def rows(self) -> int:
        return len(self.first) - 1


def grams(h: np.ndarray, k: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Hash of the ``k`` words from each position on (entries that run over the end are junk)."""
    with np.errstate(over="ignore"):
        out, have, power = np.zeros(len(h), U64), 0, U64(1)
        step, width, base = h.copy(), 1, U64(base)
        while True:
            if k & width:
                tail = np.zeros(len(h), U64)
                if have < len(h):
                    tail[: len(h) - have] = step[have:]
                out = out + power * tail
                power, have = power * base, have + width
            if width * 2 > k:
                break
            nxt = np.zeros(len(h), U64)
            if width < len(h):
                nxt[: len(h) - width] = step[width:]
            step, base, width = step + base * nxt, base * base, width * 2
        return mix(out)


def wide_grams(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of the ``k`` words from each position on, as two independent halves."""
    return grams(h, k), grams(mix(h ^ U64(0xA0761D6478BD642F)), k, 0x8EBC6AF09C88C6E3)
