"""Exact substring deduplication by relative Lempel-Ziv parsing against a distributed index.

Method.  The reference is every document, cut into blocks by content: each window of ``n``
words belongs to the block named by its minimizer (the smallest hash among its ``GRAM``-word
grams), so equal windows always meet in the same block.  Blocks with one occurrence cannot
hold a repeat and are never expanded; in the others every window is indexed at the place
where it occurs first (document, then word) under 128 bits of hash of its words.

A document is then factored greedily.  A factor begins at the first window that the index
holds at an earlier place, and is extended word by word while the next window is found at the
next word of the same source; so it is ``n`` words or more, with a source document and word.
At its end the windows that cross the boundary are looked up in turn, and the first one found
begins the next factor, which may overlap the last; breaking a factor never loses a repeat.
The factors' union is what is removed.

Documents are distinct texts (their words' 128-bit hash) numbered in the order of doc_id.
Minimizers (about one in eight words) and the windows of repeated blocks are shuffled; counts
and first places are combined before the shuffle, and where occurrences meet the index again
both sides are plain tables, so Spark splits the partition of a passage that a third of all
documents share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.words import U64, Words, grams, lists, slices, utf8, wide_grams
from meterline.plans.cluster import Scratch, ship

WINDOW, GRAM = 20, 6
FACTOR_TYPE = "array<struct<first:int,end:int,source:bigint,source_first:int>>"
FACTORS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("source_first", pa.int32())]))


def _sliding(a: np.ndarray, k: int, f) -> np.ndarray:
    """f over [i, i + k) for each i (junk where that runs over the end)."""
    have, s = 1, a
    while have * 2 <= k:
        n = s.copy()
        if have < len(s):
            f(s[:-have], s[have:], out=n[:-have])
        s, have = n, have * 2
    r = k - have
    if r and r < len(s):
        n = s.copy()
        f(s[:-r], s[r:], out=n[:-r])
        s = n
    return s


def _row_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


class _Windows:
    """Windows of the rows of a column: which positions start one, and each one's minimizer."""

    def __init__(self, w: Words, n: int):
        self.row = _row_of(w.first)
        at = np.arange(len(w.hash))
        self.valid = at + n <= w.first[1:][self.row] if len(at) else np.zeros(0, bool)
        self.gram = grams(w.hash, GRAM) if len(at) else np.zeros(0, U64)
        self.least = _sliding(self.gram, n - GRAM + 1, np.minimum)

    def anchors(self, n: int) -> np.ndarray:
        """Positions whose gram is the minimizer of a window that holds it."""
        span = n - GRAM + 1
        got = np.zeros(len(self.gram) + span, U64)
        got[span : span + len(self.gram)] = np.where(self.valid, self.least, U64(0))
        # largest minimizer among the windows starting in [i - span + 1, i]
        return np.flatnonzero(_sliding(got, span, np.maximum)[1 : 1 + len(self.gram)] == self.gram)


def joined(w: Words, off: np.ndarray, keep: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each row joined by one space: bytes and row offsets."""
    data = w.data.copy()
    mark = np.zeros(len(data) + 1, np.int8)
    start, end, row = w.start, w.end, _row_of(w.first)
    if keep is not None:
        start, end, row = start[keep], end[keep], row[keep]
    mark[start] += 1
    np.subtract.at(mark, end, 1)
    take = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    if len(start):
        more = np.append(row[1:] == row[:-1], False)
        data[end[more]] = 0x20
        take[end[more]] = True
    return data[take], np.concatenate([[0], np.cumsum(take)])[off]


def _scan(n: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                col = part.column("text")
                w = Words(col)
                body, off = joined(w, utf8(col)[1], None)
                win = _Windows(w, n)
                at = win.anchors(n)
                cut = np.searchsorted(win.row[at] if len(at) else at, np.arange(w.rows() + 1))
                values = win.gram[at].view(np.int64)
                q1, q2, sha = [], [], []
                for i in range(w.rows()):
                    raw = body[off[i] : off[i + 1]].tobytes()
                    d = xxhash.xxh3_128_intdigest(raw)
                    q1.append((d >> 64) - (1 << 63))
                    q2.append((d & (2**64 - 1)) - (1 << 63))
                    sha.append(hashlib.sha256(raw).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(w.first)), pa.array(q1, pa.int64()), pa.array(q2, pa.int64()), pa.array(sha), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(values))],
                    names=["doc_id", "text_hash", "n_words", "q1", "q2", "sha", "anchors"],
                )

    return run


def _repeated(win: _Windows, hits) -> np.ndarray:
    """Mask of window starts whose minimizer is one of its row's repeated anchors."""
    out = np.zeros(len(win.gram), bool)
    values, off = lists(hits)
    values = values.view(U64)
    edges = np.searchsorted(win.row, np.arange(len(off)))
    for i in range(len(hits)):
        a, e = edges[i], edges[i + 1]
        out[a:e] = np.isin(win.least[a:e], values[off[i] : off[i + 1]])
    return out & win.valid


def _expand(n: int, bits: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"))
                win = _Windows(w, n)
                at = np.flatnonzero(_repeated(win, part.column("hits")))
                place = (part.column("row").to_numpy()[win.row[at]] << bits) + at - w.first[win.row[at]]
                yield pa.RecordBatch.from_arrays([*(pa.array(h[at].view(np.int64)) for h in wide_grams(w.hash, n)), pa.array(place)], names=["h1", "h2", "place"])

    return run


def parse(start: np.ndarray, source: np.ndarray, n: int) -> np.ndarray:
    """Factors (first word, end word, source place) of a document from its windows with an earlier place.

    ``start`` are the windows' words in ascending order, ``source`` their first places.  A
    window goes on with the factor at hand if both it and its source are one word further;
    else it is a boundary and begins a factor of its own.
    """
    if not len(start):
        return np.zeros((0, 3), np.int64)
    new = np.flatnonzero((np.diff(start) != 1) | (np.diff(source) != 1)) + 1
    head, last = np.concatenate([[0], new]), np.concatenate([new, [len(start)]]) - 1
    return np.stack([start[head], start[last] + n, source[head]], axis=1)


def union(spans: np.ndarray) -> np.ndarray:
    """Disjoint [first, end) of ``spans`` sorted by their first words."""
    if not len(spans):
        return spans[:, :2]
    upto = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > upto[:-1]]))
    return np.stack([spans[new, 0], upto[np.concatenate([new[1:], [len(spans)]]) - 1]], axis=1)


def _factor(n: int, bits: int, texts: bool):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                col = part.column("text")
                w = Words(col)
                place, off = lists(part.column("start"))
                source, _ = lists(part.column("source"))
                gone = np.zeros(len(w.hash) + 1, np.int32)
                factors, spans = [], []
                for i in range(w.rows()):
                    start, at = np.unique(place[off[i] : off[i + 1]], return_index=True)
                    found = parse(start.astype(np.int64), source[off[i] : off[i + 1]][at], n)
                    cover = union(found)
                    gone[w.first[i] + cover[:, 0]] += 1
                    np.subtract.at(gone, w.first[i] + cover[:, 1], 1)
                    spans.append(cover.tolist())
                    factors.append([{"first": a, "end": e, "source": p >> bits, "source_first": p & ((1 << bits) - 1)} for a, e, p in found.tolist()])
                lost = np.cumsum(gone[:-1]) > 0
                body, off = joined(w, utf8(col)[1], ~lost)
                kept = [body[off[i] : off[i + 1]].tobytes() for i in range(w.rows())]
                total = np.concatenate([[0], np.cumsum(lost)])[w.first]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(np.diff(total), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(factors, FACTORS), pa.array([x.decode() for x in kept] if texts else [None] * len(kept), pa.string())],
                    names=["row", "removed", "kept_sha", "spans", "factors", "kept_text"],
                )

    return run


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs``, a table written in its final order, with ``row``: 0, 1, ... in that order (one count a partition is collected)."""
    part, at = F.shiftrightunsigned("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    upto, offsets = 0, []
    for r in docs.groupBy(part.alias("part")).agg((F.max(at) + 1).alias("n")).orderBy("part").collect():
        offsets += [upto] * (r["part"] + 1 - len(offsets))
        upto += r["n"]
    return docs.withColumn("row", F.get(F.lit(offsets or [0]).cast("array<long>"), part.cast("int")) + at).drop("place")


def substring_dedup(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_words, n_removed, kept_sha256, spans, factors, kept_text, text_hash.

    A word goes if a window of ``window`` consecutive words covers it whose word sequence
    also starts earlier: in a smaller doc_id, or in the same document at an earlier word.
    ``factors`` lists (first, end, source, source_first): words [first, end) of the document
    repeat those from ``source_first`` on of the source document, named by its number in the
    order of documents (:func:`factors` resolves it to a doc_id).  ``spans`` is their union;
    ``kept_text`` holds the remaining words joined by one space when ``texts`` is set (else null).

    Defined cases: a null or wordless text has no words and keeps the empty string; fewer
    than ``window`` words lose nothing; a null doc_id sorts before all others; rows that share
    a doc_id (or have none) are one document if their words are the same and get the same
    result, else documents of their own in the order of their words' hash; an empty table
    gives an empty result; further columns of ``docs``, whatever their names, are ignored.
    """
    return _parsed(docs, window, texts)[0]


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The factors of all documents as rows: doc_id, first, end, source_id, source_first."""
    out, names = _parsed(docs, window, False)
    long = out.select("doc_id", F.explode("factors").alias("f")).select("doc_id", "f.*")
    return long.join(names.withColumnRenamed("row", "source"), "source").select("doc_id", "first", "end", "source_id", "source_first")


def _parsed(docs: DataFrame, window: int, texts: bool) -> tuple[DataFrame, DataFrame]:
    """The result and the doc_id (``source_id``) of each numbered document."""
    if window <= GRAM:
        raise ValueError(f"window must be over {GRAM} words")
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "substring")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    parsed = scratch.keep(src.mapInArrow(_scan(window), "doc_id long, text_hash long, n_words long, q1 long, q2 long, sha string, anchors array<long>"), "parsed")
    # distinct texts, each at the smallest (nulls first) of its ids, in order
    least = F.min(F.struct("doc_id", "text_hash")).alias("at")
    first = parsed.where(F.col("n_words") >= window).groupBy("q1", "q2").agg(least, F.first("n_words").alias("n"), F.first("anchors").alias("anchors")).select("q1", "q2", F.col("at.doc_id").alias("id"), F.col("at.text_hash").alias("text_hash"), "n", "anchors")
    first = first.orderBy(F.asc_nulls_first("id"), "q1", "q2").withColumn("place", F.monotonically_increasing_id())
    first = _numbered(scratch.keep(first, "first"))
    scan = scratch.keep(parsed.drop("anchors"), "scan")
    scratch.drop("parsed")
    ends = first.agg(F.max("row").alias("row"), F.max("n").alias("n")).first()
    bits = int(ends["n"] or 1).bit_length()
    if (ends["row"] or 0) >> (62 - bits):
        raise OverflowError("documents times words of the longest one exceed 62 bits")
    # blocks with two occurrences or more, and the documents that hold them
    again = scratch.keep(first.select(F.explode("anchors").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    held = first.select("row", F.explode(F.array_distinct("anchors")).alias("h")).join(again, "h")
    hits = held.groupBy("row").agg(F.collect_list("h").alias("hits"))
    key = ["id", "no_id", "text_hash"]
    whole_id = lambda c: (F.coalesce(c, F.lit(0)).alias("id"), F.isnull(c).alias("no_id"), "text_hash")
    named = first.select("row", *whole_id(F.col("id"))).join(hits, "row")
    wide = scratch.keep(src.select(*whole_id(F.col("doc_id")), "text").join(named, key).dropDuplicates(key).select("row", "text", "hits"), "wide", "zstd")
    first = scratch.keep(first.drop("anchors"), "documents")
    scratch.drop("again", "first")
    occ = wide.mapInArrow(_expand(window, bits), "h1 long, h2 long, place long")
    index = occ.groupBy("h1", "h2").agg(F.min("place").alias("source"), F.max("place").alias("z")).where("source < z").drop("z")
    index = scratch.keep(index, "index")
    found = occ.join(index, ["h1", "h2"]).where("place > source").select(F.shiftright("place", bits).alias("row"), F.col("place").bitwiseAND((1 << bits) - 1).cast("int").alias("start"), "source")
    found = found.groupBy("row").agg(F.collect_list(F.struct("start", "source")).alias("f")).select("row", F.col("f.start").alias("start"), F.col("f.source").alias("source"))
    done = scratch.keep(wide.join(found, "row").select("row", "text", "start", "source").mapInArrow(_factor(window, bits, texts), f"row long, removed long, kept_sha string, spans array<array<int>>, factors {FACTOR_TYPE}, kept_text string"), "done")
    scratch.drop("wide", "index")
    empty = hashlib.sha256(b"").hexdigest()
    own = first.select("q1", "q2", "row", "id").join(done, "row", "left")
    out = scan.drop("anchors").join(own, ["q1", "q2"], "left")
    copy = F.col("row").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("id"))
    n = F.col("n_words")
    whole = F.struct(F.lit(0).alias("first"), n.cast("int").alias("end"), F.col("row").alias("source"), F.lit(0).alias("source_first"))
    out = out.select(
        "doc_id",
        "n_words",
        F.when(copy, n).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.array(F.array(F.lit(0), n.cast("int")))).otherwise(F.coalesce("spans", F.array().cast("array<array<int>>"))).alias("spans"),
        F.when(copy, F.array(whole)).otherwise(F.coalesce("factors", F.array().cast(FACTOR_TYPE))).alias("factors"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        "text_hash",
    )
    return out, first.select("row", F.col("id").alias("source_id"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) with repeated windows cut from ``text``; texts that lose nothing stay as they are.

    ``n_chars`` is set to the new length where such a column exists.
    """
    found = substring_dedup(docs, window, texts=True).where("n_removed > 0")
    cut = found.select(F.col("doc_id").alias("cut_id_"), F.col("text_hash").alias("cut_hash_"), F.col("kept_text").alias("cut_text_")).dropDuplicates(["cut_id_", "cut_hash_"])
    own = F.col("doc_id").cast("long").eqNullSafe(F.col("cut_id_")) & (F.xxhash64(F.col("text").cast("string")) == F.col("cut_hash_"))
    got = docs.join(cut, own, "left")
    text = F.coalesce("cut_text_", F.col("text"))
    size = F.when(F.col("cut_text_").isNotNull(), F.length("cut_text_")).otherwise(F.col("n_chars")).cast("long") if "n_chars" in docs.columns else None
    return got.select(*(text.alias(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))
