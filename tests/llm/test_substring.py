"""Relative Lempel-Ziv parsing: results against brute force, and every factor against its source."""

import hashlib
import re

import numpy as np

from meterline.llm import substring

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, n=20):
    """(n_words, n_removed, kept_sha256) of each distinct (id, words), documents in order with nulls first."""
    docs = sorted({(-1 if k is None else k, tuple(words(t))) for k, t in rows}, key=lambda x: x[0])
    seen, want = set(), {}
    for k, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if w[i : i + n] in seen:
                gone[i : i + n] = [True] * n
            seen.add(w[i : i + n])
        want[k, w] = len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()
    return want


def corpus(seed):
    r = np.random.default_rng(seed)
    passage, rows = [f"p{i}" for i in range(90)], []
    for k in range(50):
        w = [f"w{x}" for x in r.integers(0, 25, r.integers(0, 90))]
        for _ in range(int(r.integers(0, 3))):
            a, b = sorted(r.integers(0, 91, 2).tolist())
            at = int(r.integers(0, len(w) + 1))
            w[at:at] = passage[a:b]
        rows.append((k, (" " if k % 2 else "\n").join(w)))
    return rows


def test_factors_repeat_their_sources(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {x["doc_id"]: x for x in substring.substring_dedup(df).collect()}
    want = brute(rows)
    assert {(k, tuple(words(t))): (got[k]["n_words"], got[k]["n_removed"], got[k]["kept_sha256"]) for k, t in rows} == want
    text, covered = {k: words(t) for k, t in rows}, {}
    found = substring.factors(df).collect()
    assert found
    for f in found:
        size = f["end"] - f["first"]
        assert size >= 20 and (f["source_id"], f["source_first"]) < (f["doc_id"], f["first"])
        assert text[f["doc_id"]][f["first"] : f["end"]] == text[f["source_id"]][f["source_first"] : f["source_first"] + size]
        covered.setdefault(f["doc_id"], set()).update(range(f["first"], f["end"]))
    assert {k: len(v) for k, v in covered.items()} == {k: x["n_removed"] for k, x in got.items() if x["n_removed"]}
    assert all({i for a, b in x["spans"] for i in range(a, b)} == covered.get(k, set()) for k, x in got.items())


def test_shared_and_absent_ids(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(7, a), (7, b), (None, a), (None, "x " + b), (9, a + " " + b), (9, a + " " + b), (11, "short"), (12, None)]
    got = substring.substring_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    cut = substring.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(cut) == len(rows)
    want = {(None, 30): 0, (None, 31): 0, (7, 30): 30, (9, 60): 60, (11, 1): 0, (12, 0): 0}
    assert all(x["n_removed"] == want[x["doc_id"], x["n_words"]] for x in got)
    assert sorted((str(x["doc_id"]), len(words(x["text"]))) for x in cut) == sorted((str(k), n - gone) for (k, n), gone, m in [(k, want[k], 2 if k[0] in (7, 9) else 1) for k in want] for _ in range(m))


def test_parse_breaks_where_the_source_does():
    got = substring.parse(np.array([3, 4, 5, 9, 10, 11]), np.array([100, 101, 102, 7, 8, 40]), 20)
    assert got.tolist() == [[3, 25, 100], [9, 30, 7], [11, 31, 40]]
    assert substring.union(got).tolist() == [[3, 31]]


def test_ties_and_long_texts(spark):
    same = " ".join(["w"] * 70)  # every window equals the first one
    long = " ".join(f"v{i % 4001} t{i}" for i in range(40_000))
    rows = [(3, same), (4, long), (5, long + " " + same), (6, same + " end")]
    got = {x["doc_id"]: x for x in substring.substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute(rows)
    for k, t in rows:
        assert (got[k]["n_words"], got[k]["n_removed"], got[k]["kept_sha256"]) == want[k, tuple(words(t))]
