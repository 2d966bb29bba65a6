"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, cut further after each word whose hash is divisible by eight, so an
edit moves only the cuts next to it.  Its digest covers its words and its occurrence number
in the document.  A sketch adds every digest into one cell of each of three sub-tables
(count, sum of digests, sum of their checks).  Two sketches of one size subtract cell by
cell; cells left with one digest are peeled until none is left, which recovers the digests
that only one version has.  Where peeling stops early the pair is tried again with twice
the cells, until it succeeds.  Likeness is shared paragraphs over all paragraphs.

Sketching and peeling run on all rows of a slice at once.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.words import U64, Words, mix
from meterline.plans.cluster import ship

CELLS, CUT = 8, 8
_STEP = U64(0xA0761D6478BD642F)


class Digests:
    """Paragraph digests of the rows of a string column: ``key`` and each row's first index."""

    def __init__(self, col):
        w = Words(col)
        n = len(w.hash)
        if not n:
            self.key, self.first = np.zeros(0, U64), np.zeros(w.rows() + 1, np.int64)
            return
        lines = np.concatenate([[0], np.cumsum(w.data == 10)])
        begin = np.zeros(n, bool)
        begin[1:] = (lines[w.start[1:]] != lines[w.end[:-1]]) | (w.hash[:-1] % U64(CUT) == 0)
        begin[w.first[:-1][np.diff(w.first) > 0]] = True
        at = np.flatnonzero(begin)
        size = np.diff(np.append(at, n))
        pos = np.arange(n) - np.repeat(at, size)
        power = np.cumprod(np.full(pos.max() + 1, _STEP), dtype=U64)
        key = mix(np.add.reduceat(w.hash * power[pos], at) + size.astype(U64))
        self.first = np.searchsorted(at, w.first)
        row = np.repeat(np.arange(w.rows()), np.diff(self.first)).astype(U64)
        order = np.lexsort((np.arange(len(key)), key, row))
        k, r = key[order], row[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        start = np.flatnonzero(new)
        again = np.arange(len(k)) - np.repeat(start, np.diff(np.append(start, len(k))))
        key[order] = mix(k + again.astype(U64) * _STEP)
        self.key = key

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digests of the given rows, and which of them each belongs to."""
        a, n = self.first[rows], self.first[rows + 1] - self.first[rows]
        upto = np.concatenate([[0], np.cumsum(n)])
        return self.key[np.repeat(a - upto[:-1], n) + np.arange(upto[-1])], np.repeat(np.arange(len(rows)), n)


def _check(key: np.ndarray) -> np.ndarray:
    return mix(key ^ U64(0x5851F42D4C957F2D)) & U64(0xFFFFFFFF)


def _places(key: np.ndarray, owner: np.ndarray, cells: int) -> np.ndarray:
    """The three cells of each digest in its owner's table of ``3 * cells``."""
    return np.stack([owner * 3 * cells + j * cells + (mix(key + U64((j + 1) * 0x9E3779B9 + cells)) % U64(cells)).astype(np.int64) for j in range(3)])


class Sketches:
    """Tables of many owners in flat arrays: count, sum of digests, sum of checks (mod 2**64)."""

    def __init__(self, owners: int, cells: int):
        self.cells = cells
        n = owners * 3 * cells
        self.count, self.key, self.check = np.zeros(n, np.int64), np.zeros(n, U64), np.zeros(n, U64)

    def add(self, key: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> None:
        s = sign.astype(np.int64).view(U64)
        c = _check(key)
        for at in _places(key, owner, self.cells):
            np.add.at(self.count, at, sign)
            np.add.at(self.key, at, key * s)
            np.add.at(self.check, at, c * s)

    def peel(self, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests on the left side only and on the right side only, for each owner, and whether all were recovered."""
        left, right = np.zeros(owners, np.int64), np.zeros(owners, np.int64)
        width, look = 3 * self.cells, np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            key = self.key[look] * sign.view(U64)
            owner, j = look // width, look % width // self.cells
            ok = (self.check[look] * sign.view(U64) == _check(key)) & (_places(key, owner, self.cells)[j, np.arange(len(look))] == look)
            key, owner, sign = key[ok], owner[ok], sign[ok]
            _, one = np.unique(mix(key) + owner.astype(U64), return_index=True)
            key, owner, sign = key[one], owner[one], sign[one]
            if not len(key):
                break
            left += np.bincount(owner[sign > 0], minlength=owners)
            right += np.bincount(owner[sign < 0], minlength=owners)
            self.add(key, owner, -sign)
            touched = np.unique(_places(key, owner, self.cells))
            look = touched[np.abs(self.count[touched]) == 1]
        rest = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return left, right, ~rest.reshape(owners, width).any(axis=1)


def likeness(a: Digests, rows_a: np.ndarray, b: Digests, rows_b: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Shared over all paragraphs of each pair of rows, by subtracting sketches and peeling; larger on failure."""
    na, nb = a.first[rows_a + 1] - a.first[rows_a], b.first[rows_b + 1] - b.first[rows_b]
    out, todo = np.ones(len(rows_a)), np.flatnonzero((na > 0) | (nb > 0))
    while len(todo):
        failed = []
        step = max(1, (1 << 20) // (3 * cells))
        for lo in range(0, len(todo), step):
            t = todo[lo : lo + step]
            s = Sketches(len(t), cells)
            ka, oa = a.of(rows_a[t])
            kb, ob = b.of(rows_b[t])
            s.add(np.concatenate([ka, kb]), np.concatenate([oa, ob]), np.concatenate([np.ones(len(ka), np.int64), -np.ones(len(kb), np.int64)]))
            left, right, ok = s.peel(len(t))
            out[t] = (na[t] - left) / np.maximum(1, nb[t] + left)
            failed.append(t[~ok])
        todo, cells = np.concatenate(failed), cells * 2
    return out


def fingerprints(d: Digests, cells: int = CELLS) -> list[str]:
    """Each row's sketch as text: its paragraph count, then base64 of counts, digest sums and check sums."""
    rows = len(d.first) - 1
    s = Sketches(rows, cells)
    key, owner = d.of(np.arange(rows))
    s.add(key, owner, np.ones(len(key), np.int64))
    w = 3 * cells
    count, keys, check = s.count.astype("<i4").reshape(rows, w), s.key.astype("<u8").reshape(rows, w), (s.check & U64(0xFFFFFFFF)).astype("<u4").reshape(rows, w)
    n = np.diff(d.first)
    return [f"{n[i]}:" + base64.b64encode(count[i].tobytes() + keys[i].tobytes() + check[i].tobytes()).decode() for i in range(rows)]


def fingerprint_texts(texts: DataFrame, cells: int = CELLS) -> DataFrame:
    """``texts(doc_id, text, ...)`` to doc_id, fingerprint: the sketch of every whole text."""
    ship(texts.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints(Digests(batch.column("text")), cells), pa.string())], names=["doc_id", "fingerprint"])

    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def _versions(cells: int):
    def emit(rows: list[tuple]):
        """rows: (doc_id, text) with, as the last, only a successor."""
        texts = [t for _, t in rows]
        edited = []
        for i in range(len(rows) - 1):
            n = len(texts[i])
            edited.append(texts[i][: n - n // 4] + texts[i + 1][: n // 4])
        d, e = Digests(pa.array(texts, pa.large_string())), Digests(pa.array(edited, pa.large_string()))
        own = np.arange(len(edited))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in rows[:-1]], pa.int64()),
                pa.array([len(x) for x in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array(fingerprints(d, cells)[:-1], pa.string()),
                pa.array(fingerprints(e, cells), pa.string()),
                pa.array(likeness(d, own, e, own, cells)),
                pa.array(likeness(d, own, d, own + 1, cells)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches):
        rows: list[tuple] = []
        size, bucket, over = 0, None, False
        for batch in batches:
            for b, tail, doc, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "tail", "doc_id", "text")), strict=True):
                if b != bucket:
                    rows, bucket, over, size = [], b, False, 0
                if over:
                    continue
                rows.append((doc, text or ""))
                size += len(rows[-1][1])
                over = bool(tail)
                if len(rows) > 1 and (over or size > 2_000_000):
                    yield emit(rows)
                    rows, size = rows[-1:], len(rows[-1][1])

    return run


def successor_fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Fingerprints each text and its edited version, and compares it with that and with the next document.

    The edited text is the text with its last quarter (rounded down, in code points) replaced
    by the beginning of the next document by ascending doc_id (after the last: the first).
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The texts are shuffled once: into ranges of doc_id, where the first row of each range is
    also sent to the range before it.  Only the ranges' first ids reach the driver.

    Defined cases: null texts are empty, two empty texts have likeness 1; rows that share a
    doc_id are ordered by text; a null doc_id comes first; a single document is its own next;
    an empty table gives no rows; further columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    order = F.coalesce(F.col("doc_id"), F.lit(low))
    parts = src.select(order.alias("o")).repartitionByRange(ranges, "o").groupBy(F.spark_partition_id()).agg(F.min("o").alias("o")).collect()
    heads = sorted(r["o"] for r in parts)
    if not heads:
        heads = [low]
    n = len(heads)
    steps = [1 << i for i in range(n.bit_length(), -1, -1)]
    bounds = ",".join(f"{h}L" if h != low else "-9223372036854775807L - 1L" for h in heads)
    find = f"aggregate(array({','.join(map(str, steps))}), 0, (lo, s) -> if(lo + s < {n} and element_at(array({bounds}), lo + s + 1) <= o, lo + s, lo))"
    put = src.withColumn("o", order).withColumn("b", F.expr(find))
    head = F.element_at(F.expr(f"array({bounds})"), F.col("b") + 1) == F.col("o")
    spot = lambda b, tail: F.struct(b.cast("int").alias("bucket"), F.lit(tail).alias("tail"))
    here = spot(F.col("b"), 0)
    put = put.withColumn("at", F.explode(F.when(head, F.array(here, spot((F.col("b") + n - 1) % n, 1))).otherwise(F.array(here))))
    put = put.select("at.bucket", "at.tail", "o", "doc_id", "text").repartition(max(1, ranges // 4), "bucket").sortWithinPartitions("bucket", "tail", "o", "text")
    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return put.select("bucket", "tail", "doc_id", "text").mapInArrow(_versions(cells), kinds)
