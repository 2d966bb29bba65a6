"""Byte-level BPE ids of whole texts, vectorised over distinct word units.

A *unit* is a word with the white space before it.  Pre-tokenisation never joins text across
a unit's start, so a text's ids are its units' ids in order.  Each slice hashes its units
with numpy and tokenises only units not met before; ids are then gathered, not recomputed.
Texts for which that split would not be exact (other Unicode white space, trailing white
space, the text of a special token) go to the tokenizer whole.
"""

from __future__ import annotations

import base64
import re
from itertools import chain
from pathlib import Path

import numpy as np
import xxhash

from meterline.llm.words import U64, Words, mix, utf8

_ODD = re.compile("[\x85\xa0  -     　]|[\\s]\\Z|<\\|")
#: Units remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 400_000


class Encoder:
    """``path``: a tokenizers JSON file; a ``.tiktoken`` file of the same name beside it is used for speed."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        ranks = Path(path).with_suffix(".tiktoken")
        if ranks.exists():
            import public_tokenizers
            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.open("rb"))}
            self.one = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        else:
            self.one = lambda s: self.whole.encode(s, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _learn(self, keys: list[int], texts: list[str]) -> None:
        found = [self.one(x) for x in texts]
        n = np.fromiter(map(len, found), np.int64, len(found))
        i, total = len(self.known), int(n.sum())
        if (short := self.used + total - len(self.ids)) > 0:
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), short), np.uint32)])
        if (short := i + len(n) - len(self.at)) > 0:
            self.at, self.size = (np.concatenate([x, np.zeros(max(len(x), short), np.int64)]) for x in (self.at, self.size))
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.at[i : i + len(n)], self.size[i : i + len(n)] = self.used + np.cumsum(n) - n, n
        self.used += total
        self.known.update(zip(keys, range(i, i + len(n)), strict=True))

    def rows(self, col) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's rows, and each row's first index in them."""
        if len(self.known) > REMEMBERED:
            self._forget()
        data, off = utf8(col)
        texts = [x or "" for x in col.to_pylist()]
        odd = np.array([bool(x) and _ODD.search(x) is not None for x in texts], bool)
        w = Words(col)
        before = np.zeros(len(w.start), np.int64)
        if len(before):
            before[1:] = w.end[:-1]
            has = np.flatnonzero(np.diff(w.first))
            before[w.first[:-1][has]] = off[:-1][has]
        gap = w.start - before
        tag = np.zeros(len(gap), U64)
        one = gap == 1
        tag[one] = data[before[one]]
        for i in np.flatnonzero(gap > 1):
            tag[i] = xxhash.xxh3_64_intdigest(data[before[i] : w.start[i]].tobytes())
        key = mix(w.hash + mix(tag + U64(1)))
        kinds, where, back = np.unique(key, return_index=True, return_inverse=True)
        keys, known = kinds.tolist(), self.known
        new = [j for j, k in enumerate(keys) if k not in known]
        if new:
            raw, p = data.tobytes(), where[new]
            self._learn([keys[j] for j in new], [raw[a:b].decode() for a, b in zip(before[p].tolist(), w.end[p].tolist(), strict=True)])
        got = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        unit = got[back]
        n, at = self.size[unit], self.at[unit]
        upto = np.concatenate([[0], np.cumsum(n)])
        flat = self.ids[np.repeat(at - upto[:-1], n) + np.arange(upto[-1])]
        first = upto[w.first]
        if not odd.any():
            return flat, first
        parts = [np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32) if odd[i] else flat[first[i] : first[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
