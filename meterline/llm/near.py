"""MinHash near-duplicate detection with tensored banding, verified on full shingle sets.

Method.  A document's set holds its distinct shingles of ``k`` words (ASCII lower-cased).
``m`` collections of ``t`` minhashes each are computed (``m * t`` hashes in all) and every
*pair* of collections forms the key of one table, so ``m (m - 1) / 2`` tables of ``2 t``
minhashes come from a number of hashes near the square root of what separate tables need.

Work is kept linear in each group:

* equal sets collapse to one representative before anything else;
* a collection value that one document alone has cannot be part of a shared table key, so
  only shared values are combined into keys;
* each table bucket is linked as a star (smallest id against every member) and the star's
  pairs are verified on the full sets; no bucket ever lists its pairs;
* what a star cannot decide - members of one bucket that still lie in different components -
  is finished exactly by a prefix filter: two sets with the wanted similarity must share one
  of their rarest shingles, and only pairs from different components are compared.  A shingle
  that many sets have is not joined as it is: see ``_cross``.

Components come from alternating star contractions, each round a pair of aggregations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.words import U64, Words, grams, mix, slices
from meterline.plans.cluster import Scratch, checked_broadcast, ship

K, COLLECTIONS, PER = 5, 14, 3
#: Rows of a key, or pairs a row, up to which the exact finish joins a key without looking closer.
GROUP = 64
#: A key is deepened only if that saves so many pairs for each row that the deeper keys take.
DEEPER = 4


def shingle_sets(col, k: int = K) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row; shorter rows are one shingle, wordless rows none."""
    w = Words(col, lower=True)
    g = grams(w.hash, k)
    for a, e in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        n = e - a
        if n >= k:
            s = np.sort(g[a : e - k + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif n:
            yield np.array([xxhash.xxh3_64_intdigest(w.hash[a:e].tobytes(), n)], U64)
        else:
            yield np.zeros(0, U64)


class _Hashes:
    """Seeded minhash functions; the same on every worker."""

    def __init__(self, m: int, t: int, seed: int):
        r = np.random.Generator(np.random.PCG64(seed))
        self.m, self.t = m, t
        self.a = r.integers(0, 2**64, m * t, dtype=U64) | U64(1)
        self.b = r.integers(0, 2**64, m * t, dtype=U64)

    def collections(self, s: np.ndarray) -> np.ndarray:
        low = np.full(self.m * self.t, np.iinfo(U64).max, U64)
        for i in range(0, len(s), 1024):
            h = s[i : i + 1024, None] * self.a + self.b
            np.minimum(low, h.min(axis=0), out=low)
        out = np.arange(self.m, dtype=U64)
        for j in range(self.t):
            out = mix(out * U64(0x9E3779B97F4A7C15) + low[j :: self.t])
        return out.view(np.int64)


def _signatures(k: int, m: int, t: int, seed: int):
    def run(batches):
        hashes = _Hashes(m, t, seed)
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, h1, h2, cols = [], [], [], []
                for s in shingle_sets(part.column("text"), k):
                    raw = s.tobytes()
                    sizes.append(len(s))
                    d = xxhash.xxh3_128_intdigest(raw)
                    h1.append((d >> 64) - (1 << 63))
                    h2.append((d & (2**64 - 1)) - (1 << 63))
                    cols.append(hashes.collections(s) if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(cols, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "h1", "h2", "cols"])

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.view(np.int64) for s in shingle_sets(part.column("text"), k)], pa.list_(pa.int64()))], names=["id", "s"])

    return run


def _linked(num: int, den: int):
    """Verifies pairs: sorted int64 arrays ``s`` and ``p`` on each row."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                left, right = part.column("s"), part.column("p")
                keep = []
                for i in range(part.num_rows):
                    x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(den * both >= num * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(spark, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Smallest reachable id of every id in ``edges(a, b)``: columns id, comp.

    Alternates large-star and small-star contractions until nothing changes; each round
    pre-aggregates its minima, so a vertex of any degree is only ever summed, not collected.
    """
    cur = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), f"{name}-0")
    n, was = 0, None
    while True:
        n += 1
        both = cur.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(cur.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo <> hi").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("hi")), F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e")).select("e.*").where("lo <> hi").distinct()
        nxt = scratch.keep(small, f"{name}-{n}")
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")), F.count(F.when(F.col("lo") > F.col("hi"), 1))).first()
        scratch.drop(f"{name}-{n - 1}")
        cur = nxt
        if now == was:
            break
        was = now
    return cur.select(F.col("hi").alias("id"), F.col("lo").alias("comp"))


def _cross(scratch: Scratch, ranked: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) between components of ``ranked(id, comp, n, o)``; no pair that links is left out.

    ``o`` are a set's shingles from the rarest on, ``n - need + 2`` at least.  Two sets that link share a shingle among
    the first ``n - need + 1`` of each, and ``l`` shingles among the first ``n - need + l``.
    Rows meet under a key, at first one shingle.  A key of at most ``GROUP`` rows is joined
    as it is.  In a larger one sizes and positions are counted first and only those
    combinations are joined whose sets can still reach the wanted overlap; where even these
    leave more than ``GROUP`` pairs a row and ``DEEPER`` for each row of the deeper keys, the key is deepened by the next shared shingle.
    """
    spare = f"n - cast(ceil(n * {percent} / 100.0) as int)"
    first = ranked.select("id", "comp", "n", F.posexplode(F.slice("o", 1, F.expr(f"{spare} + 1"))).alias("pos", "t"))
    rows, found, level = first.where("t.df > 1").select("id", "comp", "n", "pos", F.col("t.s").alias("key")), [], 1
    # above 50 percent, two different sets that link share two shingles at least
    deepest = 2 if percent > 50 else 1
    for level in range(1, deepest + 1):
        rows = scratch.keep(rows, f"rows-{level}")
        each = rows.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum(F.expr(f"{spare} + {level} - pos")).alias("g"))
        many = each.groupBy("key").agg(F.sum("c").alias("m"), F.sum("g").alias("deeper"), F.count("*").alias("comps"))
        many = scratch.keep(many.where("comps > 1").drop("comps"), f"keys-{level}")
        reach = f"100 * least(n, nb) >= {percent} * greatest(n, nb) and {100 + percent} * ({level - 1} + least(n - pos, nb - pb)) >= {percent} * (n + nb)"
        right = lambda df: df.withColumnsRenamed({"id": "b", "comp": "cb", "n": "nb", "pos": "pb", "c": "c2"})
        cold = rows.join(many.where(f"m <= {GROUP}").select("key"), "key")
        found.append(cold.join(right(cold), "key").where(f"comp < cb and {reach}").select(F.col("id").alias("a"), "b"))
        large = many.where(f"m > {GROUP}")
        if large.isEmpty():
            break
        warm = scratch.keep(rows.join(large, "key"), f"warm-{level}")
        kinds = scratch.keep(warm.groupBy("key", "n", "pos", "comp").agg(F.count("*").alias("c")), f"kinds-{level}")
        cells = kinds.groupBy("key", "n", "pos").agg(F.sum("c").alias("c"))
        meet = scratch.keep(cells.join(right(cells), "key").where(reach), f"meet-{level}")
        # pairs of each key that would be formed: all that meet, less those within a component
        within = kinds.join(meet.drop("c", "c2"), ["key", "n", "pos"]).join(kinds.select("key", F.col("n").alias("nb"), F.col("pos").alias("pb"), "comp", F.col("c").alias("c2")), ["key", "nb", "pb", "comp"])
        pairs = meet.select("key", (F.col("c") * F.col("c2")).alias("p")).unionByName(within.select("key", (-F.col("c") * F.col("c2")).alias("p"))).groupBy("key").agg((F.sum("p") / 2).alias("pairs"))
        hot = scratch.keep(pairs.where("pairs > 0").join(large, "key").select("key", F.expr(f"pairs > {GROUP} * m + {DEEPER} * deeper and {level} < {deepest}").alias("hot")), f"hot-{level}")
        # sizes, positions and components that meet, then their rows
        some = kinds.join(hot.where("not hot").select("key"), "key").drop("c")
        met = some.join(meet.select("key", "n", "pos", "nb", "pb"), ["key", "n", "pos"]).join(right(some), ["key", "nb", "pb"]).where("comp < cb")
        left = warm.select("id", "key", "n", "pos", "comp")
        found.append(met.join(left, ["key", "n", "pos", "comp"]).join(right(left), ["key", "nb", "pb", "cb"]).select(F.col("id").alias("a"), "b"))
        deep = hot.where("hot").select("key")
        if level == deepest or deep.isEmpty():
            break
        more = warm.join(deep, "key").join(ranked.select("id", "o"), "id")
        more = more.select("id", "comp", "n", "key", "pos", F.posexplode(F.expr(f"slice(o, pos + 2, {spare} + {level} - pos)")).alias("j", "t")).where("t.df > 1")
        rows = more.select("id", "comp", "n", (F.col("pos") + 1 + F.col("j")).alias("pos"), F.xxhash64("key", "t.s").alias("key"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = scratch.keep(out.distinct(), "cross")
    scratch.drop(*(f"{x}-{i}" for i in range(1, level + 1) for x in ("rows", "keys", "warm", "kinds", "meet", "hot")))
    return out


def near_duplicates(docs: DataFrame, k: int = K, percent: int = 80, m: int = COLLECTIONS, t: int = PER, seed: int = 11) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_shingles, component_id, kept.

    Links two documents when ``100 * |A & B| >= percent * |A | B|`` on their full sets.
    ``percent`` is 80 unless a caller's contract says otherwise.  The tables miss a pair when
    fewer than two of 14 collections agree: with probability 4e-5 at similarity 0.85, 7e-4 at
    0.80 and less above; other members of its group often link it all the same.

    Defined cases: a null or wordless text has an empty set, links with nothing and is its
    own component; fewer than ``k`` words form one shingle; rows that share a doc_id are one
    document (all linked); a null doc_id is a vertex of no link and is kept; an empty table
    gives an empty result; further columns of ``docs``, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "near")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = scratch.keep(src.mapInArrow(_signatures(k, m, t, seed), "doc_id long, n_shingles long, h1 long, h2 long, cols array<long>"), "sig")
    reps = scratch.keep(sig.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.max("n_shingles").alias("n"), F.first("cols").alias("cols")), "reps")
    # collection values that at least two sets share, then the keys of the tables they span
    col = reps.select(F.col("rep").alias("id"), F.posexplode("cols").alias("j", "c"))
    shared = col.groupBy("j", "c").agg(F.count("*").alias("n")).where("n > 1").select("j", "c")
    live = col.join(shared, ["j", "c"]).groupBy("id").agg(F.array_sort(F.collect_set(F.struct("j", "c"))).alias("cs")).where(F.size("cs") > 1)
    pair = F.flatten(F.transform("cs", lambda x: F.transform(F.filter("cs", lambda y: y["j"] > x["j"]), lambda y: F.xxhash64(x["j"], x["c"], y["j"], y["c"]))))
    members = scratch.keep(live.select("id", F.explode(pair).alias("key")), "members")
    pivot = members.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("key", "a")
    hot = scratch.keep(members.join(pivot, "key").select("key", F.col("id").alias("b"), "a"), "hot")
    scratch.drop("members")
    ids = hot.select(F.col("b").alias("id")).distinct()
    ids = scratch.keep(ids, "ids")
    sizes = reps.select(F.col("rep").alias("id"), "n")
    body = src.join(checked_broadcast(ids, 16), src["doc_id"] == ids["id"], "left_semi")
    sets = scratch.keep(body.mapInArrow(_sets(k), "id long, s array<long>").distinct(), "sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Of candidate pairs (a, b), those linked on full sets; sizes alone settle many."""
        na, nb = sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), sizes.select(F.col("id").alias("b"), F.col("n").alias("nb"))
        fit = pairs.join(na, "a").join(nb, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b")
        full = fit.join(sets.select(F.col("id").alias("b"), "s"), "b").join(sets.select(F.col("id").alias("a"), F.col("s").alias("p")), "a")
        return scratch.keep(full.select("a", "b", "s", "p").mapInArrow(_linked(percent, 100), "a long, b long").distinct(), name)

    links = verified(hot.where("a <> b").select("a", "b").distinct(), "links")
    comp = components(spark, links, scratch, "cc")
    comp = scratch.keep(comp, "comp")
    # buckets that still hold two components: exact finish by the rarest shingles of their members
    tagged = hot.join(comp, hot["b"] == comp["id"], "left").select("key", F.col("b").alias("id"), F.coalesce("comp", "b").alias("comp"))
    open_ = tagged.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    rest = scratch.keep(tagged.join(open_, "key").groupBy("id").agg(F.min("comp").alias("comp")), "rest")
    tokens = sets.join(rest, "id").select("id", "comp", F.size("s").alias("n"), F.explode("s").alias("s"))
    rare = sets.join(rest, "id").select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    ranked = tokens.join(rare, "s").groupBy("id", "comp", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))
    # keys of two shingles reach one place further than those of one
    ranked = ranked.withColumn("o", F.slice("o", 1, F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 2))
    cross = _cross(scratch, scratch.keep(ranked, "ranked"), percent)
    more = verified(cross, "more")
    if not more.isEmpty():
        joined = more.join(comp, more["a"] == comp["id"], "left").select(F.coalesce("comp", "a").alias("a"), "b").join(comp, F.col("b") == comp["id"], "left").select("a", F.coalesce("comp", "b").alias("b"))
        over = components(spark, joined, scratch, "cc2")
        comp = comp.unionByName(joined.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("comp"))).distinct()
        comp = comp.join(over.select(F.col("id").alias("comp"), F.col("comp").alias("top")), "comp", "left").groupBy("id").agg(F.min(F.coalesce("top", "comp")).alias("comp"))
        comp = scratch.keep(comp, "final")
    # every row takes the component of its set's representative
    by_set = reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left").where("comp is not null or rep < last").select("h1", "h2", F.coalesce("comp", "rep").alias("c"))
    out = sig.join(by_set, ["h1", "h2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("c", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "out")
    scratch.drop("sig", "reps", "hot", "ids", "sets", "links", "comp", "rest", "ranked", "cross", "more", "final")
    return out


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``near_duplicates`` keeps: one document of each group."""
    gone = near_duplicates(docs, **options).where("not kept").select(F.col("doc_id").alias("gone_id_")).distinct()
    return docs.join(checked_broadcast(gone, 16), F.col("doc_id").cast("long") == F.col("gone_id_"), "left_anti")
