"""Minimum-bin-slack packing of token sequences.

Method.  Bins are filled one kind at a time: the longest length left is fixed and a bitset
subset-sum dynamic program over the lengths still available (a bit for every sum that can be
reached, shifted once for each copy) finds the fullest combination for the rest of the bin.
That combination stays the fullest as long as its lengths last, so it is repeated until one
of them runs out.  The planner therefore sees a histogram of at most ``size`` lengths and
makes at most one kind of bin for each exhausted length, however many documents there are.

The pieces themselves never leave the executors: each gets a rank among the pieces of its
length (position within its partition plus the counts of earlier partitions) and the small
plan maps (length, rank) to a sequence and a place in it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.tokens import Encoder
from meterline.llm.words import slices
from meterline.plans.cluster import Scratch, ship

SIZE, SEPARATOR = 2048, 0


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """Multiset of ``lengths`` (ascending, with ``counts``) whose sum is the largest up to ``room``."""
    mask, reach, stages = (1 << (room + 1)) - 1, 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[i]
        copies = min(counts[length], room // length)
        if not copies:
            continue
        stages.append((length, reach))
        for _ in range(copies):
            grown = reach | (reach << length) & mask
            if grown == reach:
                break
            reach = grown
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(stages):
        n = 0
        while not before >> target & 1:
            target -= length
            n += 1
        if n:
            chosen[length] = n
    return chosen


def plan(counts: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Kinds of bins that use up ``counts`` (length -> pieces): (repetitions, {length: pieces in one bin})."""
    left = {k: v for k, v in counts.items() if v > 0}
    lengths, out = sorted(left), []
    while lengths:
        top = lengths[-1]
        left[top] -= 1
        kind = fullest(left, lengths, size - top)
        left[top] += 1
        kind[top] = kind.get(top, 0) + 1
        times = min(left[k] // n for k, n in kind.items())
        out.append((times, kind))
        for k, n in kind.items():
            left[k] -= n * times
            if not left[k]:
                lengths.remove(k)
    return out


def _pieces(path: str, size: int, separator: int):
    def run(batches):
        from pyspark import TaskContext

        part_no = TaskContext.get().partitionId()
        encoder, seen = Encoder(path), np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, first = encoder.rows(part.column("text"))
                out: list[list] = [[] for _ in range(6)]
                for r, doc in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[first[r] : first[r + 1]], np.uint32(separator)).astype("<u4")
                    n = len(own)
                    edges = [0, *range((n - 1) % size + 1, n + 1, size)]
                    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        for c, v in zip(out, (doc, i, a, b - a, zlib.crc32(own[a:b].tobytes()), seen[b - a]), strict=True):
                            c.append(v)
                        seen[b - a] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                cols = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(cols[0]), part_no, np.int32))], names=["doc_id", "piece", "start", "length", "ids_crc32", "pos", "part"])

    return run


def _placed(kinds: list[tuple[int, dict[int, int]]]):
    rows, done, base = [], {}, 0
    for times, kind in kinds:
        offset = 0
        for length in sorted(kind, reverse=True):
            n = kind[length]
            rows.append((length, done.get(length, 0), base, n, offset))
            done[length] = done.get(length, 0) + n * times
            offset += n * length
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)

    def run(batches):
        shift = 1 << 44
        key = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(key, length * shift + rank, side="right") - 1] if len(length) else table[:0]
            q = rank - row[:, 1]
            seq = row[:, 2] + q // np.maximum(row[:, 3], 1)
            off = row[:, 4] + q % np.maximum(row[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, separator: int = SEPARATOR) -> DataFrame:
    """Packs every row of ``docs(doc_id, text, ...)`` into sequences of at most ``size`` tokens.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.  A document is its ids and the separator; only one longer than ``size`` is cut,
    into full pieces after a first one that may be shorter.

    Defined cases: null and empty texts are the separator alone; rows that repeat are packed
    again; a null doc_id stays null; an empty table gives no rows; further columns of
    ``docs``, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "pack")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = scratch.keep(src.mapInArrow(_pieces(tokenizer, size, separator), "doc_id long, piece int, start long, length long, ids_crc32 long, pos long, part int"), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # at most one row for each partition meets in a window of one length
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("base"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `size` rows
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("base") + F.col("pos"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(plan(histogram, size)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
