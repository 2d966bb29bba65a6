"""Language identification by cross-parsing entropy against suffix automata.

Method.  For each language a suffix automaton of labelled text answers "how long is the
longest match from here".  A text is parsed greedily into longest matches against each
automaton; the language that needs the fewest phrases per character wins.

The automata are dense transition tables in which a missing transition restarts at the root
and sets a phrase bit, so parsing is one table gather a symbol.  Texts are cut into rows of
``STEP`` symbols that advance in lockstep, each from a guessed state; then every row whose
predecessor ended in another state is parsed again from there, until all states agree.  The
result is the plain greedy parse of the whole text: a phrase goes on over any row's end.

A symbol is a letter (lower-cased), or one gap for a run of other characters.  Letters beyond
the commonest ``COMMON`` of the learned texts are spelled as five base-16 digits, so every
script is told apart whatever the number of its letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.words import slices
from meterline.plans.cluster import ship

STEP = 256
#: Symbols: 0 a gap, 1 to COMMON letters, then 16 digits.
COMMON, SYMBOLS = 47, 64
#: Symbols that enter one language's automaton, and all languages' automata together, at most.
CHARS, ALL_CHARS = 20_000, 640_000
_SPELL = 255


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


class Automaton:
    """Suffix automaton of a symbol sequence as a dense table (states x symbols) of targets."""

    def __init__(self, seq: np.ndarray, symbols: int):
        nxt: list[dict[int, int]] = [{}]
        link, size, last = [-1], [0], 0
        for c in seq.tolist():
            cur = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if size[p] + 1 == size[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    size.append(size[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.table = np.full((len(nxt), symbols), -1, np.int32)
        for i, t in enumerate(nxt):
            if t:
                self.table[i, list(t)] = list(t.values())


class Model:
    """``langs`` in order, the symbol of each code point, and all languages' tables in one."""

    def __init__(self, langs: list[str], texts: list[str], chars: int = CHARS):
        self.langs, letters = langs, _letters()
        seen: dict[int, int] = {}
        points = [self._points(x) for x in texts]
        for p in points:
            for c, n in zip(*np.unique(p[letters[p]], return_counts=True), strict=True):
                seen[int(c)] = seen.get(int(c), 0) + int(n)
        self.symbol = np.where(letters, _SPELL, 0).astype(np.uint8)
        self.symbol[sorted(seen, key=lambda c: (-seen[c], c))[:COMMON]] = 1 + np.arange(min(COMMON, len(seen)))
        tables, base, chars = [], 0, min(chars, ALL_CHARS // max(1, len(langs)))
        self.root = []
        for p in points:
            t = Automaton(self.symbols(p)[:chars], SYMBOLS).table
            again = np.where(t[0] >= 0, t[0], 0)
            # a phrase starts at the root, and with a symbol that is missing; one that no learned text has is a phrase of its own
            joined = np.where(t >= 0, (t + base) * 2, (again[None, :] + base) * 2 + 1)
            joined[0] |= 1
            tables.append(joined.astype(np.int32))
            self.root.append(base)
            base += len(t)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    @staticmethod
    def _points(text: str) -> np.ndarray:
        return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """A text's symbols: runs of letterless characters count once, rare letters are spelled."""
        s = self.symbol[points]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
        s, points = s[keep], points[keep]
        rare = s == _SPELL
        if rare.any():
            size = np.where(rare, 5, 1)
            out = np.repeat(s, size)
            at = (np.cumsum(size) - size)[rare]
            for k in range(5):
                out[at + k] = COMMON + 1 + ((points[rare] >> (4 * (4 - k))) & 15)
            s = out
        return s

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each text in each language, symbols parsed, and whether it has a letter."""
        parts = [self.symbols(self._points(x)) for x in texts]
        size, letter = np.array([len(s) for s in parts], np.int64), np.array([bool(s.any()) for s in parts], bool)
        rows = np.maximum(1, -(-size // STEP))
        upto = np.concatenate([[0], np.cumsum(rows)])
        own = np.repeat(np.arange(len(texts)), rows)
        flat = np.zeros(upto[-1] * STEP, np.uint8)
        lens = np.full(len(own), STEP)
        for i, s in enumerate(parts):
            flat[upto[i] * STEP : upto[i] * STEP + len(s)] = s
        if len(texts):
            lens[upto[1:] - 1] = size - (rows - 1) * STEP
        block = flat.reshape(-1, STEP)
        follows = np.arange(len(own)) != upto[own] if len(own) else np.zeros(0, bool)
        total = np.zeros((len(texts), len(self.langs)))
        for j, root in enumerate(self.root):
            enter, leave = np.full(len(own), root, np.int32), np.full(len(own), root, np.int32)
            breaks, stale = np.zeros(len(own), np.int64), np.arange(len(own))
            while len(stale):
                leave[stale], breaks[stale] = self._run(block, lens, stale, enter[stale])
                before = np.concatenate([[root], leave[:-1]])
                stale = np.flatnonzero(follows & (before != enter))
                enter[stale] = before[stale]
            total[:, j] = np.bincount(own, breaks, minlength=len(texts))
        return total, size, letter

    def _run(self, block: np.ndarray, lens: np.ndarray, rows: np.ndarray, enter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parses ``rows`` of the block in lockstep: the states they end in and the phrases that start within them."""
        order = np.argsort(-lens[rows], kind="stable")
        some = np.ascontiguousarray(block[rows[order]].T)
        live = np.searchsorted(-lens[rows[order]], -np.arange(STEP), side="left")
        state, count = enter[order].copy(), np.zeros(len(rows), np.int64)
        for t in range(STEP):
            n = live[t]
            if not n:
                break
            v = self.table[state[:n] * SYMBOLS + some[t, :n]]
            count[:n] += v & 1
            state[:n] = v >> 1
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        got, size, letter = self.phrases([x or "" for x in texts])
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = got.argmin(axis=1)
        rank = np.sort(got, axis=1)
        # share of phrases saved against the runner-up, as a probability-like score
        second = rank[:, 1] if rank.shape[1] > 1 else rank[:, 0] * 2
        score = 1 / (1 + np.exp(-np.clip(20 * (second - rank[:, 0]) / np.maximum(second, 1), 0, 30)))
        return [self.langs[b] if ok else "und" for b, ok in zip(best, letter, strict=True)], np.where(letter, score, 0.0)


def train(docs: DataFrame, folds: int = 3, held: int = 1, per_language: int = 48, chars: int = CHARS) -> Model:
    """Learns from rows with a lang outside the held-out fold (crc32 of the id's text modulo ``folds``).

    Every such language is learned.  Bounds: about ``2 * per_language`` texts are read for each
    (those whose id's hash falls in a share set by the language's row count), of each text
    ``chars`` characters, and ``chars`` symbols enter a language's automaton - fewer where
    there are so many languages that these would pass ``ALL_CHARS`` symbols together.
    """
    ship(docs.sparkSession)
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and doc_id is not null and text is not null").where(fold != held)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], [])
    share = docs.sparkSession.createDataFrame([(k, max(1, v // (2 * per_language))) for k, v in counts.items()], "lang string, every long")
    picked = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id"), F.col("every")) == 0)
    texts: dict[str, list[tuple[int, int, str]]] = {k: [] for k in counts}
    for r in picked.select("lang", "doc_id", F.substring("text", 1, chars).alias("text"), F.xxhash64("doc_id").alias("h")).toLocalIterator():
        texts[r["lang"]].append((r["h"], r["doc_id"], r["text"]))
    # where a language's few rows all miss its share, its first row by hash stands for it
    for k in [k for k in texts if not texts[k]]:
        r = rows.where(F.col("lang") == k).orderBy(F.xxhash64("doc_id"), "text").select("doc_id", F.substring("text", 1, chars).alias("text")).first()
        texts[k].append((0, r["doc_id"], r["text"]))
    langs = sorted(texts)
    return Model(langs, [" ".join(x[2] for x in _even(sorted(texts[k]), chars)) for k in langs], chars)


def _even(rows: list, chars: int) -> list:
    """Rows until their texts hold ``chars`` characters, short texts first so that many documents speak."""
    out, n = [], 0
    for r in sorted(rows, key=lambda r: (len(r[2]) > 4000, r)):
        if n >= chars * 1.5:
            break
        out.append(r)
        n += len(r[2])
    return out


def _predict(model: Model):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, model: Model, folds: int = 3, held: int = 1) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, held_out, lang_pred, score in 0..1.

    Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every
    text when nothing could be learned; ties go to the first language in name order; a null
    doc_id is in no held-out fold; repeated rows get equal results; an empty table gives no
    rows; further columns, whatever their names, are ignored.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = src.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))
    return got.select("doc_id", fold.alias("held_out"), "lang_pred", "score")
