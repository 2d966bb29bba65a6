"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, all of them).  Every passage is
encoded as byte-class, byte-pair and word-shape frequencies; a gated attention (tanh branch
times sigmoid branch, softmax over the bag) learns from document labels alone which
passages matter, and the score is the logistic of the attention-weighted passage encoding.
The model is fitted in numpy on a bounded sample of labelled rows and sent to the executors
as a few small matrices; scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.sample import smallest
from meterline.llm.words import Words, slices, utf8
from meterline.plans.cluster import ship

PASSAGE, PAIRS, HIDDEN, SHAPES = 64, 128, 16, 6
#: Bytes as one of 128 kinds: ASCII as it is, other bytes by their high bits.
_KIND = np.concatenate([np.arange(128), 1 + (np.arange(128) >> 4)]).astype(np.int64)
#: Coarse class of a byte for the pair counts.
_CLASS = np.full(256, 7, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
for _i, _c in enumerate(b".,;:!?|#$%&*@/<>=_-'\"()[]{}\\~^+`"):
    _CLASS[_c] = 4 + _i % 3
WIDTH = 128 + PAIRS + SHAPES


def passages(col, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and, for each row of the column, its first passage (an empty text has one)."""
    w = Words(col)
    n = np.diff(w.first)
    bags = np.maximum(1, -(-n // size))
    first = np.concatenate([[0], np.cumsum(bags)])
    x = np.zeros((first[-1], WIDTH), np.float32)
    x[:, -1] = np.repeat(np.log1p(n) / 10, bags)
    x[:, -6] = 1 / size
    if len(w.data):
        row = np.repeat(np.arange(len(n)), n)
        p = first[row] + (np.arange(len(row)) - w.first[row]) // size
        # a byte belongs to the passage of the word it is in or after, before the first word to the row's first
        off = utf8(col)[1]
        filled = np.flatnonzero(np.diff(off))
        byte = np.zeros(len(w.data), np.int64)
        byte[off[filled]] = first[filled]
        byte[w.start] = p
        byte = np.maximum.accumulate(byte)
        m = len(x)
        uni = np.bincount(byte * 128 + _KIND[w.data], minlength=m * 128)[: m * 128].reshape(m, 128)
        k = _CLASS[w.data]
        pair = (k[:-1] * 8 + k[1:]) + 64 * (w.data[:-1] == w.data[1:])
        inside = np.ones(len(w.data), bool)
        inside[off[1:][filled] - 1] = False  # a row's last byte has no next one
        two = np.bincount((byte[:-1] * PAIRS + pair)[inside[:-1]], minlength=m * PAIRS)[: m * PAIRS].reshape(m, PAIRS)
        total = np.maximum(1, uni.sum(1, keepdims=True)).astype(np.float32)
        x[:, :128] = np.sqrt(uni / total)
        x[:, 128 : 128 + PAIRS] = np.sqrt(two / total)
        size_w = (w.end - w.start).astype(np.float64)
        many = np.maximum(1, np.bincount(p, minlength=m)[:m])
        mean = np.bincount(p, size_w, minlength=m)[:m] / many
        x[:, -2] = mean / 10
        x[:, -3] = np.sqrt(np.maximum(0, np.bincount(p, size_w**2, minlength=m)[:m] / many - mean**2)) / 10
        x[:, -4] = _distinct(p, w.hash, m) / many
        x[:, -5] = np.repeat(_distinct(row, w.hash, len(n)) / np.maximum(1, n), bags)
        x[:, -6] = many / size
    return x, first


def _distinct(group: np.ndarray, h: np.ndarray, m: int) -> np.ndarray:
    """Distinct words of each group (44 bits of the hash decide)."""
    key = np.sort((group.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    return np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=m)[:m]


class Model:
    """Gated attention over passages; parameters are plain arrays."""

    def __init__(self, mean, scale, p):
        self.mean, self.scale, self.p = mean, scale, p

    def forward(self, x: np.ndarray, first: np.ndarray):
        p = self.p
        z = np.clip((x - self.mean) * self.scale, -6, 6)
        e = np.tanh(z @ p["E"] + p["e"])
        t, g = np.tanh(e @ p["V"]), 1 / (1 + np.exp(-(e @ p["U"])))
        s = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        s = np.exp(s - np.maximum.reduceat(s, first[:-1])[bag])
        a = s / np.add.reduceat(s, first[:-1])[bag]
        pooled = np.add.reduceat(a[:, None] * e, first[:-1])
        return z, e, t, g, a, bag, pooled, pooled @ p["c"] + p["b"]

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.forward(x, first)[-1], -30, 30)))


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 14, seed: int = 5, rate: float = 4e-3, decay: float = 2e-4) -> Model:
    """Adam on the logistic loss; without both labels the model is the constant prior."""
    r = np.random.default_rng(seed)
    rows = np.concatenate(bags) if bags else np.zeros((1, WIDTH), np.float32)
    mean, scale = rows.mean(0), 1 / np.maximum(rows.std(0), 1e-2)
    init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"E": init(WIDTH, HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, HIDDEN), "U": init(HIDDEN, HIDDEN), "w": init(HIDDEN), "c": np.zeros(HIDDEN, np.float32), "b": np.zeros(1, np.float32)}
    rate_of = (labels.sum() + 1) / (len(labels) + 2)
    p["b"][:] = np.log(rate_of / (1 - rate_of))
    model = Model(mean, scale, p)
    if len(set(labels.tolist())) < 2:
        return model
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for epoch in range(epochs):
        order = r.permutation(len(bags))
        for lo in range(0, len(order), 64):
            pick = order[lo : lo + 64]
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
            x, y = np.concatenate([bags[i] for i in pick]), labels[pick].astype(np.float32)
            z, e, t, g, a, bag, pooled, logit = model.forward(x, first)
            d = (1 / (1 + np.exp(-logit)) - y) / len(pick)
            dp = d[:, None] * p["c"]
            de = a[:, None] * dp[bag]
            da = (e * dp[bag]).sum(1)
            ds = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
            dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
            de += dt @ p["V"].T + dg @ p["U"].T
            dz = de * (1 - e * e)
            grad = {"c": pooled.T @ d, "b": np.array([d.sum()]), "w": (t * g).T @ ds, "V": e.T @ dt, "U": e.T @ dg, "E": z.T @ dz, "e": dz.sum(0)}
            step += 1
            lr = rate * (1 - epoch / (epochs + 1))
            for k, q in grad.items():
                q = q + decay * p[k] * (k in ("E", "V", "U", "c"))
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.99 * v[k] + 0.01 * q * q
                p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def _encode(size: int, bag: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x, first = passages(part.column("text"), size)
                picks = [np.arange(a, b) if b - a <= bag else np.linspace(a, b - 1, bag).astype(int) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([x[i].tobytes() for i in picks], pa.binary())], names=["doc_id", "bag"])

    return run


def train(docs: DataFrame, labels: DataFrame, most: int = 4000, folds: int = 5, size: int = PASSAGE, bag: int = 64) -> Model:
    """Fits on at most ``most`` labelled documents outside fold 0 (crc32 of the id's text modulo ``folds``).

    The sample is the rows with the smallest hash of their id, so it is the same on every
    run and independent of order; only these rows' texts are encoded, and at most ``bag``
    passages of each, evenly spread over the text, are collected (about 1 KB a passage).
    Scoring reads every passage.
    """
    ship(docs.sparkSession)
    held = F.crc32(F.col("doc_id").cast("string")) % folds == 0
    pick = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(~held)
    known = smallest(pick, "doc_id", most)
    quality = {r["doc_id"]: r["quality"] for r in known}
    if not quality:
        return fit([], np.zeros(0))
    ids = docs.sparkSession.createDataFrame([(k,) for k in sorted(quality)], "doc_id long")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id", "left_semi")
    got = sorted(chosen.mapInArrow(_encode(size, bag), "doc_id long, bag binary").collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], bytes(r["bag"])))
    return fit([np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in got], np.array([quality[r["doc_id"]] for r in got]))


def _score(model: Model, size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                s = model.score(*passages(part.column("text"), size)).astype(np.float64)
                yield part.drop_columns(["text"]).append_column("score", pa.array(s))

    return run


def quality_scores(docs: DataFrame, model: Model, threshold: float = 0.3, folds: int = 5, size: int = PASSAGE) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, held_out, score in 0..1, predicted.

    Defined cases: null and empty texts are a bag of one empty passage and get a score like
    any other; a null doc_id is in no held-out fold; repeated rows get equal scores; an empty
    table gives no rows; further columns, whatever their names, are ignored.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = src.mapInArrow(_score(model, size), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _pass(model: Model, threshold: float, size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(model.score(*passages(part.column("text"), size)) >= threshold))

    return run


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, size: int = PASSAGE) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score reaches ``threshold``; one pass, no shuffle."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_pass(model, threshold, size), docs.schema)
