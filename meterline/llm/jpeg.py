"""Progressive JPEG: scans accumulate into coefficient arrays, numpy turns those into RGB tensors.

The decoder reads any 8-bit progressive file (spectral selection, successive approximation,
restart markers, subsampled chroma): each scan adds its share to one int32 array a component.
A scan's units (Huffman code and magnitude) differ in length, so where each begins depends on
all before it: numpy reads the length of the unit that would begin at every bit, a short loop
walks from unit to unit, and numpy turns the units met into coefficients.  Refinements walk
from symbol to symbol.  Scans with restart markers are decoded bit by bit; where a table makes
every unit of a one-component scan the same number of bits long, one numpy gather does.

``encode_payload`` stores bytes losslessly as quantised coefficients (the format's own unit) of
a colour file with chroma halved both ways: 64 bytes make one block, six blocks an MCU (four of
Y, one each of Cb and Cr), each byte a signed coefficient.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.words import slices, utf8
from meterline.plans.cluster import ship

#: Zigzag order by its rule: diagonals, alternating direction.
ZIGZAG = np.array([r * 8 + c for d in range(15) for r, c in sorted(((i, d - i) for i in range(8) if 0 <= d - i < 8), reverse=d % 2 == 0)])
_DCT = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)], np.float32)


class Component:
    def __init__(self, ident: int, h: int, v: int, table: int):
        self.ident, self.h, self.v, self.table = ident, h, v, table


class Huffman:
    """Canonical code: (length, code) to symbol."""

    def __init__(self, counts: list[int], symbols: bytes):
        self.code, code, k = {}, 0, 0
        for n in range(1, 17):
            for _ in range(counts[n - 1]):
                self.code[n, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1

    @lru_cache(256)  # files repeat their tables
    def unit(self, dc: bool) -> int | None:
        """Bits of every unit (code and magnitude) if all are alike and each holds one value."""
        sizes = {n + (s if dc else s & 15) for (n, _), s in self.code.items()}
        plain = dc or all(s >> 4 == 0 and s & 15 for s in self.code.values())
        return sizes.pop() if plain and len(sizes) == 1 else None

    @lru_cache(256)
    def windows(self, dc: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every 16 bits: bits of the unit they begin with (255: no code), of its code, and its symbol."""
        whole, code_bits, symbol = np.full(1 << 16, 255, np.uint8), np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
        for (n, code), s in self.code.items():
            part = slice(code << (16 - n), (code + 1) << (16 - n))
            more = s if dc else s & 15 or (s >> 4 if s < 0xF0 else 0)
            whole[part], code_bits[part], symbol[part] = n + more, n, s
        return whole, code_bits, symbol

    @lru_cache(256)
    def values(self, unit: int) -> np.ndarray:
        """Value of every ``unit``-bit pattern."""
        out = np.zeros(1 << unit, np.int32)
        for (n, code), s in self.code.items():
            s &= 15
            m = np.arange(1 << s)
            out[(code << s) + m] = np.where(m >> max(s - 1, 0) & 1, m, m - (1 << s) + 1) if s else 0
        return out


class _Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.acc, self.have = data, 0, 0, 0

    def bits(self, n: int) -> int:
        while self.have < n:
            self.acc = (self.acc << 8) | (self.data[self.at] if self.at < len(self.data) else 0xFF)
            self.at, self.have = self.at + 1, self.have + 8
        self.have -= n
        out = self.acc >> self.have
        self.acc &= (1 << self.have) - 1
        return out

    def symbol(self, table: Huffman) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.bits(1)
            if (n, code) in table.code:
                return table.code[n, code]
        raise ValueError("bad Huffman code")

    def value(self, s: int) -> int:
        if not s:
            return 0
        v = self.bits(s)
        return v if v >> (s - 1) else v - (1 << s) + 1


_huffman = lru_cache(256)(lambda counts, symbols: Huffman(list(counts), symbols))


class Frame:
    """A decoded file: size, components with ``coef`` of shape (block rows, block columns, 64) in zigzag order."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}
        self.parts: list[Component] = []
        self.comment = b""
        self.width = self.height = 0

    def start(self, body: bytes) -> None:
        precision, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        if precision != 8:
            raise ValueError("only 8-bit samples")
        for i in range(n):
            ident, hv, t = body[6 + 3 * i : 9 + 3 * i]
            self.parts.append(Component(ident, hv >> 4, hv & 15, t))
        self.hmax, self.vmax = max(c.h for c in self.parts), max(c.v for c in self.parts)
        self.mw, self.mh = -(-self.width // (8 * self.hmax)), -(-self.height // (8 * self.vmax))
        for c in self.parts:
            c.w, c.hh = -(-self.width * c.h // self.hmax), -(-self.height * c.v // self.vmax)
            c.coef = np.zeros((self.mh * c.v, self.mw * c.h, 64), np.int32)

    def units(self, chosen: list[Component]) -> list[list[tuple[Component, int, int]]]:
        """Blocks of each MCU of a scan, in order."""
        if len(chosen) == 1:
            c = chosen[0]
            return [[(c, y, x)] for y in range(-(-c.hh // 8)) for x in range(-(-c.w // 8))]
        return [[(c, my * c.v + j, mx * c.h + i) for c in chosen for j in range(c.v) for i in range(c.h)] for my in range(self.mh) for mx in range(self.mw)]

    def rgb(self) -> np.ndarray:
        """Full-resolution (height, width, 3) uint8 tensor: inverse transform, chroma repeated, YCbCr to RGB."""
        planes = []
        for c in self.parts:
            rows, cols, _ = c.coef.shape
            x = np.zeros((rows * cols, 64), np.float32)
            x[:, ZIGZAG] = c.coef.reshape(-1, 64) * self.tables[c.table].astype(np.float32)
            x = x.reshape(-1, 8) @ _DCT  # along each row
            x = x.reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 8) @ _DCT
            x = x.reshape(rows, cols, 8, 8).transpose(0, 3, 1, 2).reshape(rows * 8, cols * 8)
            x = np.clip(np.rint(x + 128), 0, 255)  # samples are whole 8-bit numbers before colours are made
            x = np.repeat(np.repeat(x, self.vmax // c.v, 0), self.hmax // c.h, 1)
            planes.append(x[: self.height, : self.width])
        if len(planes) == 1:
            return np.repeat(planes[0].astype(np.uint8)[:, :, None], 3, 2)
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        out = np.empty((self.height, self.width, 3), np.uint8)
        for i, x in enumerate((1.402 * cr, -0.344136 * cb - 0.714136 * cr, 1.772 * cb)):
            out[:, :, i] = np.clip(np.rint(y + x), 0, 255)
        return out


def _at_every_bit(data: bytes) -> np.ndarray:
    """The 16 bits from every bit on; ones follow the last, for some bytes."""
    raw = np.frombuffer(data + b"\xff" * 8, np.uint8).astype(np.uint32)
    three = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (three[:, None] >> np.arange(8, 0, -1, dtype=np.uint32)).astype(np.uint16).ravel()


def _magnitudes(window: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Values of the first ``bits`` bits of each window."""
    x = window >> (16 - bits).astype(np.uint16)
    return x - _BELOW.take(bits << np.uint8(1) | (window >> 15).astype(np.uint8))


#: What to take from a magnitude of s bits, at 2s if its first bit is 0 and at 2s + 1 if it is 1.
_BELOW = np.array([k for s in range(16) for k in ((1 << s) - 1, 0)], np.int32)
_BELOW[:2] = 0
_PIECE = 1 << 20  # bytes of a scan that are decoded, and units that are joined, at a time


def _dc(frame: Frame, chosen, tables, ah: int, al: int, data: bytes) -> None:
    """A DC scan of one or more components."""
    alone = len(chosen) == 1
    high, wide = (-(-chosen[0][0].hh // 8), -(-chosen[0][0].w // 8)) if alone else (frame.mh, frame.mw)
    shapes = [(1, 1) if alone else (c.v, c.h) for c, _, _ in chosen]
    per = [v * h for v, h in shapes]
    n = high * wide
    if ah:
        got = np.unpackbits(np.frombuffer(data, np.uint8))[: n * sum(per)].reshape(n, -1)
    else:
        bits = _at_every_bit(data)
        turn = [tables[0, t] for (_, t, _), k in zip(chosen, per, strict=True) for _ in range(k)]
        sizes = {t: t.windows(True)[0].take(bits).tobytes() for t in set(turn)}
        met, p, order = array("q"), 0, [sizes[t] for t in turn]
        for _ in range(n):
            for size in order:
                met.append(p)
                p += size[p]
        at = np.frombuffer(met, np.int64).reshape(n, -1)
        got = np.empty(at.shape, np.int32)
        for t in sizes:
            mine = [i for i, x in enumerate(turn) if x is t]
            whole, code_bits, symbol = t.windows(True)
            places = at if len(mine) == len(turn) else at[:, mine]
            here = bits.take(places)
            if (whole.take(here) == 255).any():
                raise ValueError("bad Huffman code")
            got[:, mine] = _magnitudes(bits.take(places + code_bits.take(here)), symbol.take(here))
    for (c, _, _), (v, h), part in zip(chosen, shapes, np.split(got, np.cumsum(per)[:-1], axis=1), strict=True):
        area = c.coef[: high * v, : wide * h, 0]
        if not ah:
            part = np.cumsum(part.ravel())
        part = part.reshape(high, wide, v, h).transpose(0, 2, 1, 3).reshape(area.shape).astype(np.int32) << al
        area[:] = area | part if ah else part


def _first_band(area: np.ndarray, table: Huffman, ss: int, se: int, al: int, data: bytes) -> None:
    """The first scan of AC coefficients ``ss`` to ``se`` of one component's blocks."""
    rows, cols, _ = area.shape
    width = se - ss + 1
    band = np.zeros(rows * cols * width, np.int32)
    whole, code_bits, symbol = table.windows(False)
    p = done = 0  # bit, and place behind the last unit, all blocks' bands in one row
    for lo in range(0, len(data), _PIECE):
        bits = _at_every_bit(data[lo : lo + _PIECE + 8])
        size, met, end = whole.take(bits).tobytes(), array("q"), 8 * min(_PIECE, len(data) - lo)
        while p < end:
            met.append(p)
            p += size[p]
        p -= 8 * _PIECE
        at = np.frombuffer(met, np.int64)
        here = bits.take(at)
        bad = np.flatnonzero(whole.take(here) == 255)
        if len(bad):
            at, here = at[: bad[0]], here[: bad[0]]
        kind = symbol.take(here)
        run, s = kind >> 4, kind & 15
        after = bits.take(at + code_bits.take(here))
        step = run + np.int64(1)
        stop = np.flatnonzero((s == 0) & (run < 15))  # ends of band
        if len(stop):
            step[stop] = 0
            ends = np.cumsum(step)[stop]
            ends += done % width
            ends[1:] -= ends[:-1].copy()  # lengths from one to the next
            more = run[stop]
            step[stop] = width * (ends // width + (1 << more.astype(np.int64)) + (after[stop] >> (16 - more).astype(np.uint16))) - ends
        to = np.cumsum(step)
        to += done % width
        to += done // width * width
        done = int(to[-1]) if len(to) else done
        keep = s > 0
        if done > len(band):  # what follows the last block is filling
            keep &= to <= len(band)
        if not keep.all():
            to, s, run, after = to[keep], s[keep], run[keep], after[keep]
        to -= 1
        if run.any() and (to % width < run).any():
            raise ValueError("a run leaves its block")
        band[to] = _magnitudes(after, s) << al
        if len(bad) or done >= len(band):
            break
    if done < len(band):
        raise ValueError("the scan ends early")
    area[:, :, ss : se + 1] = band.reshape(rows, cols, width)


def _more_band(area: np.ndarray, table: Huffman, ss: int, se: int, al: int, data: bytes) -> None:
    """A refinement of AC coefficients ``ss`` to ``se``: bits of those known, and new ones of magnitude one."""
    width = se - ss + 1
    band = area[:, :, ss : se + 1].reshape(-1)
    known = np.flatnonzero(band)
    zero = np.flatnonzero(band == 0)
    before = np.searchsorted(known, np.arange(0, len(band) + 1, width)).tolist()  # known ones before each block
    _, code_bits, symbol = table.windows(False)
    data += b"\xff" * 8
    at = seen = p = 0
    starts, counts, new, signs = [], [], [], []
    while at < len(band):
        if p >= 8 * len(data) - 64:
            raise ValueError("the scan ends early")
        ahead = int.from_bytes(data[p >> 3 : (p >> 3) + 5], "big") << (p & 7) & 0xFFFFFFFFFF
        n, s = int(code_bits[ahead >> 24]), int(symbol[ahead >> 24])
        if not n:
            raise ValueError("bad Huffman code")
        run, s, rest = s >> 4, s & 15, ahead << n & 0xFFFFFFFFFF
        p += n
        if not s and run < 15:
            last = min(at // width + (1 << run) + (rest >> (40 - run)), len(before) - 1)
            p += run
            to, count = last * width, before[last] - seen
        else:
            if (i := at - seen + run) >= len(zero) or (to := int(zero[i]) + 1) > (at // width + 1) * width:
                raise ValueError("a run leaves its block")
            count = to - 1 - at - run
            if s:
                new.append(to - 1)
                signs.append(rest >> 39)
                p += 1
        starts.append(p - seen)
        counts.append(count)
        p, seen, at = p + count, seen + count, to
    if p > 8 * len(data) - 64:
        raise ValueError("the scan ends early")
    bit = np.unpackbits(np.frombuffer(data, np.uint8))[np.repeat(starts, counts) + np.arange(seen)].astype(np.int32)
    band[known] += np.sign(band[known]) * (bit << al)
    band[new] = (2 * np.array(signs, np.int32) - 1) << al
    area[:, :, ss : se + 1] = band.reshape(*area.shape[:2], width)


def _scan(frame: Frame, chosen, tables, ss: int, se: int, ah: int, al: int, chunks: list[bytes], restart: int) -> None:
    c = chosen[0][0]
    one = len(chosen) == 1 and not restart
    rows, cols = -(-c.hh // 8), -(-c.w // 8)
    area = c.coef[:rows, :cols] if one else None
    if one and ss == 0 and not ah and (unit := tables[0, chosen[0][1]].unit(True)) and unit <= 16:
        bits = np.unpackbits(np.frombuffer(chunks[0], np.uint8))[: rows * cols * unit].reshape(-1, unit)
        diff = tables[0, chosen[0][1]].values(unit)[bits @ (1 << np.arange(unit - 1, -1, -1))]
        area[:, :, 0] = (np.cumsum(diff) << al).reshape(rows, cols)
        return
    if ss == 0 and not restart:
        _dc(frame, chosen, tables, ah, al, chunks[0])
        return
    if one and not ah and (unit := tables[1, chosen[0][2]].unit(False)) and unit <= 16:
        n = rows * cols * (se - ss + 1)
        raw = np.frombuffer(chunks[0], np.uint8)
        at = raw[:n] if unit == 8 else np.unpackbits(raw)[: n * unit].reshape(-1, unit) @ (1 << np.arange(unit - 1, -1, -1))
        area[:, :, ss : se + 1] = (tables[1, chosen[0][2]].values(unit)[at] * (1 << al)).reshape(rows, cols, -1)
        return
    if one:
        (_more_band if ah else _first_band)(area, tables[1, chosen[0][2]], ss, se, al, chunks[0])
        return
    _by_bits(frame, chosen, tables, ss, se, ah, al, chunks, restart)


def _by_bits(frame: Frame, chosen, tables, ss: int, se: int, ah: int, al: int, chunks: list[bytes], restart: int) -> None:
    units = frame.units([x[0] for x in chosen])
    of = {x[0].ident: x for x in chosen}
    step = restart or len(units)
    for k, lo in enumerate(range(0, len(units), max(1, step))):
        bits, run, last = _Bits(chunks[k]), 0, dict.fromkeys(of, 0)
        for mcu in units[lo : lo + step]:
            for comp, y, x in mcu:
                block = comp.coef[y, x]
                if ss == 0:
                    if ah:
                        block[0] |= bits.bits(1) << al
                    else:
                        last[comp.ident] += bits.value(bits.symbol(tables[0, of[comp.ident][1]]))
                        block[0] = last[comp.ident] << al
                elif not ah:
                    run = _first_ac(bits, tables[1, of[comp.ident][2]], block, ss, se, al, run)
                else:
                    run = _more_ac(bits, tables[1, of[comp.ident][2]], block, ss, se, al, run)


def _first_ac(bits: _Bits, table: Huffman, block, k: int, se: int, al: int, run: int) -> int:
    if run:
        return run - 1
    while k <= se:
        s = bits.symbol(table)
        r, s = s >> 4, s & 15
        if s:
            k += r
            block[k] = bits.value(s) * (1 << al)
            k += 1
        elif r == 15:
            k += 16
        else:
            return (1 << r) - 1 + (bits.bits(r) if r else 0)
    return 0


def _more_ac(bits: _Bits, table: Huffman, block, k: int, se: int, al: int, run: int) -> int:
    add = 1 << al

    def correct(i: int) -> None:
        if bits.bits(1):
            block[i] += add if block[i] > 0 else -add

    if not run:
        while k <= se:
            s = bits.symbol(table)
            r, s = s >> 4, s & 15
            new = 0
            if s:
                new = add if bits.bits(1) else -add
            elif r < 15:
                run = (1 << r) + (bits.bits(r) if r else 0)
                break
            while k <= se:
                if block[k]:
                    correct(k)
                elif r:
                    r -= 1
                else:
                    block[k] = new
                    k += 1
                    break
                k += 1
    if run:
        for i in range(k, se + 1):
            if block[i]:
                correct(i)
        run -= 1
    return run


def decode(data: bytes) -> Frame:
    """Parses a progressive file and accumulates all of its scans."""
    frame, tables, restart, at = Frame(), {}, 0, 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    raw = np.frombuffer(data, np.uint8)
    ff = np.flatnonzero(raw[:-1] == 0xFF)
    nxt = raw[ff + 1]
    marks = ff[(nxt != 0) & ((nxt < 0xD0) | (nxt > 0xD7)) & (nxt != 0xFF)]
    while at < len(data):
        kind = data[at + 1]
        if kind == 0xD9:
            break
        (size,) = struct.unpack(">H", data[at + 2 : at + 4])
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if kind == 0xDB:
            while body:
                wide, ident = body[0] >> 4, body[0] & 15
                n = 128 if wide else 64
                frame.tables[ident] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[1 + n :]
        elif kind == 0xC2:
            frame.start(body)
        elif kind in (0xC0, 0xC1, 0xC3) or 0xC5 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise ValueError("not a progressive file")
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0] >> 4, body[0] & 15] = _huffman(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif kind == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif kind == 0xFE:
            frame.comment = body
        elif kind == 0xDA:
            n = body[0]
            by = {c.ident: c for c in frame.parts}
            chosen = [(by[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
            ss, se, a = body[1 + 2 * n : 4 + 2 * n]
            i = np.searchsorted(marks, at)
            end = int(marks[i]) if i < len(marks) else len(data)
            part = data[at:end]
            chunks = [part] if not restart else _restarts(part)
            _scan(frame, chosen, tables, ss, se, a >> 4, a & 15, [x.replace(b"\xff\x00", b"\xff") for x in chunks], restart)
            at = end
    return frame


def _restarts(part: bytes) -> list[bytes]:
    out, lo, i = [], 0, part.find(b"\xff")
    while i >= 0:
        if i + 1 < len(part) and 0xD0 <= part[i + 1] <= 0xD7:
            out.append(part[lo:i])
            lo = i + 2
        i = part.find(b"\xff", i + 2)
    return [*out, part[lo:]]


def _segment(kind: int, body: bytes) -> bytes:
    return bytes([0xFF, kind]) + struct.pack(">H", len(body) + 2) + body


def _table(ident: int, bits: dict[int, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A table segment, and each symbol's code and its length, for ``bits`` of a code by symbol."""
    order = sorted(bits, key=lambda s: (bits[s], s))
    counts = bytes(sum(n == k for n in bits.values()) for k in range(1, 17))
    codes, sizes = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for (n, code), s in Huffman(list(counts), bytes(order)).code.items():
        codes[s], sizes[s] = code, n
    return _segment(0xC4, bytes([ident]) + counts + bytes(order)), codes, sizes


#: Fixed codes: letters have magnitudes of six bits or five, zeros little but at the end.
_DC_TABLE = _table(0x00, {0: 3, 1: 5, 2: 4, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 8: 6})
_AC_TABLE = _table(0x10, {r << 4 | s: 12 for r in range(16) for s in range(8)} | {0x00: 6, 6: 1, 5: 2, 7: 4, 4: 4, 3: 5, 2: 6, 1: 6})
_MORE_TABLE = _table(0x11, {r << 4 | s: 7 for r in range(16) for s in range(2)} | {0x00: 2, 0x01: 2, 0x11: 3})
_FLAT = _segment(0xDB, bytes([0, *([1] * 64)]))
_MCU = 6  # blocks of an MCU: Y two by two, Cb, Cr
_LONGEST = 32767  # blocks an end of band can cover
_BLOCKS = 1 << 14  # blocks whose units are made at a time


def _bit_strings(units: np.ndarray, sizes: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """For each file numbers of ``sizes`` bits (at most 32 each) one after the other, then ones up to a byte.

    ``edges`` holds each file's first number, and behind the last file's the end.
    """
    end = np.cumsum(sizes, dtype=np.int64)
    edge = np.where(edges > 0, end[edges - 1], 0) if len(end) else np.zeros(len(edges), np.int64)
    bits = edge[1:] - edge[:-1]
    words = np.concatenate([[0], np.cumsum((bits + 31) >> 5)])
    shift = 32 * words[:-1] - edge[:-1]
    out = np.zeros(words[-1] + 1, np.uint32)
    for lo in range(0, len(units), _PIECE):
        part = slice(lo, lo + _PIECE)
        at = end[part] - sizes[part]
        inside = np.clip(edges - lo, 0, len(at))
        at += np.repeat(shift, inside[1:] - inside[:-1])
        word = at >> 5
        new = np.ones(len(word), bool)
        new[1:] = word[1:] != word[:-1]
        first = np.flatnonzero(new)
        both = np.bitwise_or.reduceat(units[part].astype(np.uint64) << (64 - sizes[part] - (at & 31)).astype(np.uint64), first)
        out[word[first]] |= (both >> np.uint64(32)).astype(np.uint32)
        out[word[first] + 1] |= both.astype(np.uint32)
    raw = bytearray(out.astype(">u4").tobytes())
    found = []
    for w, n in zip(words[:-1].tolist(), bits.tolist(), strict=True):
        part = raw[4 * w : 4 * w + (n + 7) // 8]
        if n:
            part[-1] |= (1 << -n % 8) - 1
        found.append(bytes(part.replace(b"\xff", b"\xff\x00")))
    return found


def _sized(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each value's magnitude and those bits."""
    size = _SIZE[np.abs(values)]
    return size, np.where(values < 0, values + (1 << size) - 1, values)


_SIZE = np.array([k.bit_length() for k in range(256)])


def _band(values: np.ndarray, table: tuple[bytes, np.ndarray, np.ndarray], edges: np.ndarray, known: np.ndarray | None = None, low: np.ndarray | None = None) -> list[bytes]:
    """One AC scan of each file over rows of ``values``, a block's band each: the coefficients that become known.

    Files begin at the blocks ``edges`` (and end at its last). In a refinement ``known`` marks those known before (whose ``values`` are zero) and ``low`` has their next bits.
    """
    made = []
    for a in range(0, len(values), _BLOCKS):
        some = slice(a, a + _BLOCKS)
        made.append(_band_units(values[some], table, np.clip(edges - a, 0, len(values[some])), *(None if x is None else x[some] for x in (known, low))))
    units, sizes, cuts = zip(*made, strict=True)
    return _bit_strings(np.concatenate(units), np.concatenate(sizes), sum(cuts))


def _band_units(values: np.ndarray, table: tuple[bytes, np.ndarray, np.ndarray], edges: np.ndarray, known: np.ndarray | None, low: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of some blocks of ``_band``, their sizes, and how many come before each file."""
    _, codes, sizes = table
    n, width = values.shape
    known = None if known is None or not known.any() else known.ravel()
    place = np.flatnonzero(values)
    block = place // width
    lead = np.ones(len(block), bool)  # first of its block
    lead[1:] = block[1:] != block[:-1]
    # runs count the coefficients that are not known
    rank = None if known is None else np.concatenate([[0], np.cumsum(~known)])
    zeros_before = (lambda x: x) if rank is None else rank.__getitem__
    begin = np.where(lead, zeros_before(block * width), zeros_before(np.concatenate([[-1], place[:-1]]) + 1))
    run = zeros_before(place) - begin
    size, extra = _sized(values.ravel()[place].astype(np.int64))
    kind = (run & 15) << 4 | size
    unit, bits, to = codes[kind] << size | extra, sizes[kind] + size, place + 1

    # a block's rest is an end of band, with the blocks behind it that hold nothing
    has, full, alone = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n + 1, bool)
    has[block], full[block[to % width == 0]] = True, True
    alone[edges] = True
    alone[:n] |= has
    start = alone[:n].copy()
    start[1:] |= full[:-1]
    start = np.flatnonzero(start & ~full)
    holders = np.flatnonzero(alone)
    count = holders[np.searchsorted(holders, start, "right")] - start
    if len(count) and count.max() > _LONGEST:
        parts = -(-count // _LONGEST)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, count = np.repeat(start, parts) + nth * _LONGEST, np.minimum(np.repeat(count, parts) - nth * _LONGEST, _LONGEST)
    power = np.frexp(count.astype(float))[1] - 1
    more_unit, more_bits, more_to = codes[power << 4] << power | count - (1 << power), sizes[power << 4] + power, (start + count) * width
    if (run > 15).any():
        times = run >> 4
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        last = np.repeat(begin, times) + 16 * nth + 15  # the run's sixteenth
        last = last if known is None else np.flatnonzero(~known)[last]
        more_unit = np.concatenate([more_unit, np.full(len(last), codes[0xF0])])
        more_bits = np.concatenate([more_bits, np.full(len(last), sizes[0xF0])])
        more_to = np.concatenate([more_to, last + 1])
        order = np.argsort(more_to)
        more_unit, more_bits, more_to = more_unit[order], more_bits[order], more_to[order]
    unit, bits, to = _merged(np.searchsorted(to, more_to), (unit, more_unit), (bits, more_bits), (to, more_to))
    cuts = np.searchsorted(to, edges * width, "right")
    if known is not None:  # behind each unit the bits of the known ones that it passes
        passed = np.zeros_like(to)
        passed[1:] = to[:-1]
        unit, bits = _merged(passed - rank[passed], (low.ravel()[known], unit), (np.ones(n * width - rank[-1], np.int64), bits))
        cuts = cuts + edges * width - rank[edges * width]
    return unit.astype(np.uint32), bits.astype(np.uint8), cuts


def _merged(spot: np.ndarray, *pairs: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The second array of each pair put into the first, before its elements ``spot``."""
    if not len(spot):
        return [a for a, _ in pairs]
    spot = spot + np.arange(len(spot))
    rest = np.ones(len(pairs[0][0]) + len(spot), bool)
    rest[spot] = False
    found = []
    for a, b in pairs:
        out = np.empty(len(rest), b.dtype)
        out[spot], out[rest] = b, a
        found.append(out)
    return found


def _sos(parts: list[int], table: int, ss: int, se: int, ah: int, al: int) -> bytes:
    return _segment(0xDA, bytes([len(parts), *(x for c in parts for x in (c, table)), ss, se, ah << 4 | al]))


def encode_payload(payload: bytes) -> bytes:
    """``payload`` (a multiple of 64 bytes) as a file: see ``encode_payloads``."""
    return encode_payloads([payload])[0]


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """Progressive YCbCr files, chroma halved both ways, whose coefficients are the ``payloads`` (multiples of 64 bytes).

    Six blocks in turn make an MCU: four of Y, one of Cb, one of Cr. Files are made side by
    side; none depends on the others.
    """
    if not payloads:
        return []
    n = -(-np.array([len(x) for x in payloads]) // (64 * _MCU))
    rows = np.clip(-(-n // 16), 1, 4000)  # a side holds at most 65535 samples
    cols = np.maximum(1, -(-n // rows))
    n = rows * cols
    edges = np.concatenate([[0], np.cumsum(n)])
    data = np.frombuffer(b"".join(x.ljust(64 * _MCU * k, b"\0") for x, k in zip(payloads, n.tolist(), strict=True)), np.int8).reshape(-1, _MCU, 64)
    # Y's blocks row by row
    wide = np.repeat(2 * cols, 4 * n)
    down, across = np.divmod(np.arange(4 * len(data)) - np.repeat(4 * edges[:-1], 4 * n), wide)
    y = data[np.repeat(edges[:-1], 4 * n) + (down >> 1) * (wide >> 1) + (across >> 1), (down & 1) * 2 + (across & 1)]
    cb, cr = data[:, 4], data[:, 5]
    dc = data[:, :, 0].astype(np.int64)
    half = dc >> 1
    ahead = half[:, [3, 0, 1, 2, 4, 5]]  # what each is predicted from: the same component's block before
    ahead[1:, [0, 4, 5]] = half[:-1, [3, 4, 5]]
    ahead[edges[:-1, None], [0, 4, 5]] = 0
    size, extra = _sized((half - ahead).ravel())

    def first(part: np.ndarray, at: np.ndarray) -> list[bytes]:
        return _band((part + (part < 0)) >> 1, _AC_TABLE, at)  # halves, towards zero

    def more(part: np.ndarray, at: np.ndarray) -> list[bytes]:
        new = np.abs(part) == 1
        return _band(np.where(new, part, 0), _MORE_TABLE, at, (part != 0) & ~new, part & 1)

    scans = [
        (_sos([1, 2, 3], 0x00, 0, 0, 0, 1), _bit_strings(_DC_TABLE[1][size] << size | extra, _DC_TABLE[2][size] + size, _MCU * edges)),
        (_sos([1], 0x00, 1, 5, 0, 1), first(y[:, 1:6], 4 * edges)),
        (_sos([3], 0x00, 1, 63, 0, 1), first(cr[:, 1:], edges)),
        (_sos([2], 0x00, 1, 63, 0, 1), first(cb[:, 1:], edges)),
        (_sos([1], 0x00, 6, 63, 0, 1), first(y[:, 6:], 4 * edges)),
        (_sos([1, 2, 3], 0x00, 0, 0, 1, 0), _bit_strings((dc & 1).ravel(), np.ones(dc.size, np.int64), _MCU * edges)),
        (_sos([3], 0x01, 1, 63, 1, 0), more(cr[:, 1:], edges)),
        (_sos([2], 0x01, 1, 63, 1, 0), more(cb[:, 1:], edges)),
        (_sos([1], 0x01, 1, 63, 1, 0), more(y[:, 1:], 4 * edges)),
    ]
    tables = _DC_TABLE[0] + _AC_TABLE[0] + _MORE_TABLE[0]
    files = []
    for i, (payload, high, wide) in enumerate(zip(payloads, (16 * rows).tolist(), (16 * cols).tolist(), strict=True)):
        frame = _segment(0xC2, struct.pack(">BHHB", 8, high, wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        files.append(b"".join([b"\xff\xd8", _segment(0xFE, struct.pack(">Q", len(payload))), _FLAT, frame, tables, *(x for head, made in scans for x in (head, made[i])), b"\xff\xd9"]))
    return files


def read_payload(frame: Frame) -> bytes:
    """The bytes that ``encode_payload`` stored."""
    (n,) = struct.unpack(">Q", frame.comment)
    # each component's blocks in MCU order
    parts = [c.coef.reshape(frame.mh, c.v, frame.mw, c.h, 64).transpose(0, 2, 1, 3, 4).reshape(frame.mh, frame.mw, c.h * c.v, 64) for c in frame.parts]
    return np.concatenate(parts, axis=2).reshape(-1)[:n].astype(np.int8).tobytes()


def features(rgb: np.ndarray) -> str:
    """Size, and mean and deviation of each channel."""
    x = rgb.reshape(-1, 3)
    total = max(1, len(x))
    mean = x.sum(0, dtype=np.int64) / total
    dev = np.sqrt(np.maximum(0, np.square(x.astype(np.float32)).sum(0, dtype=np.float64) / total - mean**2))
    return f"{rgb.shape[0]}x{rgb.shape[1]}" + "".join(f";{c}={m:.3f},{d:.3f}" for c, m, d in zip("rgb", mean, dev, strict=True))


def decode_media(media: DataFrame, column: str = "media") -> DataFrame:
    """Adds height, width and rgb (full-resolution bytes, row by row) to rows with progressive files.

    Nulls and bytes that are no progressive JPEG give nulls; other columns are kept.
    """
    ship(media.sparkSession)
    names = [c for c in media.columns if c not in ("height", "width", "rgb")]
    schema = T.StructType([*media.select(*names).schema.fields, T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("rgb", T.BinaryType())])

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for raw in batch.column(column).to_pylist():
                try:
                    x = decode(raw).rgb() if raw else None
                except (ValueError, IndexError, KeyError, struct.error):
                    x = None
                out.append((None, None, None) if x is None else (*x.shape[:2], x.tobytes()))
            cols = [pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*names, "height", "width", "rgb"])

    return media.select(*names).mapInArrow(run, schema)


def padded(text: bytes) -> bytes:
    return text + bytes(64 - len(text) % 64 if len(text) % 64 or not text else 0)


def encode_texts(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` as doc_id, n_bytes and ``media``: the whole padded text as a progressive file."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                data, off = utf8(part.column("text"))
                raw = data.tobytes()
                media = encode_payloads([padded(raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(off)), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def read_texts(stored: DataFrame) -> DataFrame:
    """Payload digests and features of ``stored(doc_id, n_bytes, media)``, all computed from the media column."""
    ship(stored.sparkSession)
    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media binary"

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for file in batch.column("media"):
                file = file.as_py()
                frame = decode(file)
                back = read_payload(frame)
                for c, v in zip(out, (len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(file), hashlib.sha256(file).hexdigest(), features(frame.rgb())), strict=True):
                    c.append(v)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, k) for c, k in zip(out, types, strict=True)), batch.column("media")], names=[x.split()[0] for x in kinds.split(", ")])

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, kinds)


def store_texts(docs: DataFrame, media: bool = False) -> DataFrame:
    """Stores every whole text of ``docs(doc_id, text, ...)`` as a progressive file in a column and reads that column back.

    Returns doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the bytes read
    back), media_bytes, media_sha256 (of the stored file), feature (of the decoded tensor)
    and, with ``media``, the file itself.

    Defined cases: null and empty texts are 64 zero bytes; equal texts give equal values; a
    null doc_id stays null; an empty table gives no rows; further columns are ignored.
    """
    got = read_texts(encode_texts(docs))
    return got if media else got.drop("media")
