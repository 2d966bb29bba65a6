"""The exact finish of near-duplicate detection: hot shingles, deepened keys, recall."""

import itertools

import numpy as np
import pytest

from meterline.llm import near
from meterline.plans.cluster import Scratch


def linked(x, y, percent):
    both = len(x & y)
    return 100 * both >= percent * (len(x) + len(y) - both)


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("group", [1, 4, 64])
def test_cross_loses_no_link(spark, percent, group, monkeypatch):
    monkeypatch.setattr(near, "GROUP", group)
    monkeypatch.setattr(near, "DEEPER", 0 if group < 64 else 4)
    r = np.random.default_rng(percent + group)
    sets = []
    for base in range(6):
        core = set(range(100 * base, 100 * base + int(r.integers(5, 26))))
        for _ in range(25):
            x = set(core)
            for v in r.choice(sorted(core), int(r.integers(0, 3)), replace=False):
                x.discard(int(v))
            x |= {int(v) for v in r.integers(0, 700, int(r.integers(0, 3)))}
            sets.append(frozenset(x))
    sets = sorted(set(sets), key=sorted)
    df = {}
    for v in itertools.chain(*sets):
        df[v] = df.get(v, 0) + 1
    comp = r.integers(0, 40, len(sets)).tolist()
    rows = [(i, c, len(x), sorted((df[v], v) for v in x)) for i, (x, c) in enumerate(zip(sets, comp, strict=True))]
    ranked = spark.createDataFrame(rows, "id long, comp long, n int, o array<struct<df:long,s:long>>")
    got = {(x["a"], x["b"]) for x in near._cross(Scratch(spark, "t"), ranked, percent).collect()}
    assert all(comp[a] < comp[b] for a, b in got)
    want = {(a, b) for a, b in itertools.permutations(range(len(sets)), 2) if comp[a] < comp[b] and linked(sets[a], sets[b], percent)}
    assert want and want <= got


def test_common_template_links_nothing(spark):
    head = " ".join(f"t{i}" for i in range(22))
    rows = [(i, f"{head} a{i} b{i}") for i in range(3000)]
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert all(x["kept"] and x["n_shingles"] == 20 for x in got) and len(got) == 3000


def test_null_and_shared_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, "other"), (3, text), (3, "a b"), (5, text + " more"), (6, None), (7, "A b")]
    got = sorted((str(x["doc_id"]), x["n_shingles"], x["component_id"], x["kept"]) for x in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [x for x in got if x[0] != "None"] == [("3", 1, 3, True), ("3", 36, 3, True), ("5", 37, 3, False), ("6", 0, 6, True), ("7", 1, 3, False)]
    assert all(x[3] for x in got if x[0] == "None")


def test_recall(spark):
    """Share of planted pairs found at a set similarity just over the threshold."""
    r = np.random.default_rng(0)
    for percent, size, at in ((80, 64, (20, -1)), (85, 69, (20,))):  # similarities 54/66 and 60/70
        rows = []
        for i in range(1500):
            w = [f"w{x}" for x in r.integers(0, 10**6, size)]
            v = ["x" if j in (at[0], size + at[-1]) else x for j, x in enumerate(w)]
            rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
        found = sum(not x["kept"] for x in got)
        print("recall at", percent, found / 1500)
        assert found >= 0.995 * 1500
