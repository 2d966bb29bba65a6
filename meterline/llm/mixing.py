"""Mixing sources to target weights by hierarchical budgets.

The sources form a tree: domain, language, source.  A token budget runs from the root down;
each node deals its budget to its children by their weights, and a child that holds less
than its share (its tokens times the epochs allowed) leaves the shortage to its siblings
before any of it returns to the parent's own siblings.  Each leaf takes the prefix of its
budget from a sequence of epochs, each a seeded permutation of its documents; the document
in which the budget ends is taken whole.

Only the leaf totals reach the driver (one row a leaf, checked against ``LEAVES``).  The
prefix of a leaf is "hash at most a cutoff", found from sums over hash ranges at two levels,
so no leaf - however large - is ever sorted or gathered in one task, and selecting documents
is a broadcast of one cutoff a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.plans.cluster import Scratch

LEAVES = 200_000
LEVEL = ("domain", "lang", "source")
RANGE_BITS = 10


def words(text: str = "text") -> Column:
    """Words of a text as tokens: maximal runs without space or the controls 0x09-0x0D."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def deal(budget: int, room: list[int], weight: list[float]) -> list[int]:
    """Whole-token shares of ``budget`` by weight, none above its ``room``; shortages go to the others."""
    share, left, open_ = [0] * len(room), min(budget, sum(room)), [i for i in range(len(room)) if room[i] > 0]
    while left and open_:
        total = sum(weight[i] for i in open_)
        even = total <= 0
        want = {i: left * (1 / len(open_) if even else weight[i] / total) for i in open_}
        full = [i for i in open_ if share[i] + want[i] >= room[i]]
        if full:
            for i in full:
                left -= room[i] - share[i]
                share[i] = room[i]
            open_ = [i for i in open_ if i not in full]
            if not even and open_ and not any(weight[i] > 0 for i in open_) and left:
                continue
            left, share = left + sum(share[i] for i in open_), [0 if i in open_ else s for i, s in enumerate(share)]
            continue
        floor = {i: int(want[i]) for i in open_}
        rest = left - sum(floor.values())
        for i in sorted(open_, key=lambda i: (floor[i] - want[i], i)):
            extra = 1 if rest > 0 and share[i] + floor[i] < room[i] else 0
            share[i] += floor[i] + extra
            rest -= extra
        left = rest
    return share


def budgets(leaves: list[tuple], weights: dict[tuple, float], budget: int, epochs: int) -> list[int]:
    """Tokens of each leaf ``(domain, lang, source, tokens)``; ``weights`` by path prefix, 1 where absent."""
    out = [0] * len(leaves)

    def down(own: list[int], depth: int, tokens: int) -> None:
        if depth == len(LEVEL):
            for i, s in zip(own, deal(tokens, [leaves[i][3] * epochs for i in own], [1.0] * len(own)), strict=True):
                out[i] = s
            return
        groups: dict = {}
        for i in own:
            groups.setdefault(leaves[i][: depth + 1], []).append(i)
        keys = list(groups)
        room = [sum(leaves[i][3] for i in groups[k]) * epochs for k in keys]
        for k, s in zip(keys, deal(tokens, room, [float(weights.get(k, 1.0)) for k in keys]), strict=True):
            down(groups[k], depth + 1, s)

    down(list(range(len(leaves))), 0, budget)
    return out


def mix(docs: DataFrame, weights: dict[tuple, float], domain: Column, budget: float = 0.5, epochs: int = 2, seed: int = 1, tokens: Column | None = None) -> DataFrame:
    """``docs(doc_id, text, lang, source, ...)`` with domain_, tokens_, epochs_, partial_, taken_ added.

    ``budget``: tokens, or a share of all tokens if at most 1.  ``epochs_`` is how many whole
    epochs take the document, ``partial_`` whether the last, cut epoch takes it too,
    ``taken_`` the tokens taken in all (0: not selected).

    Defined cases: a null domain, language or source is a branch of its own; texts without a
    word hold no tokens and go with their leaf's whole epochs only; rows that repeat a doc_id
    share its place in the permutation and are taken together; a null doc_id has a place like
    any other; an empty table gives no rows; all columns of ``docs`` are kept as they are.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    n = words() if tokens is None else tokens
    own = docs.withColumns({"domain_": domain.cast("string"), "tokens_": n})
    key = ["domain_", F.col("lang").cast("string").alias("lang_"), F.col("source").cast("string").alias("source_")]
    narrow = scratch.keep(own.select(F.col("doc_id").cast("string").alias("doc"), *key, "tokens_"), "narrow")
    totals = narrow.groupBy("domain_", "lang_", "source_").agg(F.sum("tokens_").alias("t"), F.count("*").alias("n")).limit(LEAVES + 1).collect()
    if len(totals) > LEAVES:
        raise ValueError(f"more than {LEAVES} leaves; weights are meant for a tree of sources")
    leaves = sorted(((r[0], r[1], r[2], r["t"]) for r in totals), key=lambda x: [(v is not None, v or "") for v in x[:3]])
    total, rows = sum(x[3] for x in leaves), sum(r["n"] for r in totals)
    goal = int(total * budget) if budget <= 1 else int(budget)
    share = budgets(leaves, weights, goal, epochs)
    plan = [(*x[:3], i, int(b // x[3]) if x[3] else 0, int(b % x[3]) if x[3] else 0) for i, (x, b) in enumerate(zip(leaves, share, strict=True))]
    schema = "mix_d string, mix_l string, mix_s string, leaf int, mix_full int, rest long"
    table = spark.createDataFrame(plan, schema)

    def place(df: DataFrame, doc: Column, lang: Column, source: Column) -> DataFrame:
        """Adds the leaf's plan and the document's place ``h`` in the epoch that is cut."""
        got = df.join(F.broadcast(table), F.col("domain_").eqNullSafe(F.col("mix_d")) & lang.eqNullSafe(F.col("mix_l")) & source.eqNullSafe(F.col("mix_s")))
        return got.withColumn("mix_h", F.xxhash64(F.lit(seed), F.col("mix_full"), doc))

    at = place(narrow, F.col("doc"), F.col("lang_"), F.col("source_")).where("rest > 0").select("leaf", "rest", F.col("mix_h").alias("h"), "tokens_")
    bits = min(RANGE_BITS, max(1, (max(1, rows // 1000).bit_length() + 1) // 2))
    # a hash's range at two levels; the range in which a leaf's budget ends is opened row by row
    top, low = F.shiftright("h", 64 - bits), F.shiftright("h", 64 - 2 * bits)
    fine = scratch.keep(at.groupBy("leaf", "rest", top.alias("x"), low.alias("y")).agg(F.sum("tokens_").alias("t")), "ranges")
    crossing = lambda df, by, order: df.withColumn("before", F.sum("t").over(Window.partitionBy(*by).orderBy(order)) - F.col("t"))
    coarse = crossing(fine.groupBy("leaf", "rest", "x").agg(F.sum("t").alias("t")), ["leaf"], "x").where("before < rest and before + t >= rest").select("leaf", "x", F.col("before").alias("b0"))
    inner = crossing(fine.join(F.broadcast(coarse), ["leaf", "x"]), ["leaf", "x"], "y").where("b0 + before < rest and b0 + before + t >= rest").select("leaf", "y", (F.col("b0") + F.col("before")).alias("b1"))
    last = at.withColumn("y", low).join(F.broadcast(inner), ["leaf", "y"]).groupBy("leaf", "rest", "y", "b1", "h").agg(F.sum("tokens_").alias("t"))
    cut = crossing(last, ["leaf", "y"], "h").where("b1 + before < rest").groupBy("leaf").agg(F.max("h").alias("cutoff"))
    table = table.join(F.broadcast(scratch.keep(cut, "cut")), "leaf", "left").select("mix_d", "mix_l", "mix_s", "mix_full", F.col("cutoff").alias("mix_cutoff"))
    out = place(own, F.col("doc_id").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"))
    took = F.coalesce(F.col("mix_h") <= F.col("mix_cutoff"), F.lit(False))
    out = out.withColumns({"epochs_": F.col("mix_full"), "partial_": took, "taken_": F.col("tokens_") * (F.col("mix_full") + took.cast("int"))})
    scratch.drop("narrow", "ranges")
    return out.drop("mix_d", "mix_l", "mix_s", "mix_full", "mix_cutoff", "mix_h")
