"""The trained operators and the media column against plain computations, held-out accuracy and round trips."""

import hashlib
import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import jpeg, langid, quality, queries, urls

SF = "/root/testdata/sf0.01"


def greedy(model, text):
    """Longest matches one after the other, by the languages' own symbol sequences."""
    want = []
    for learned in model.learned:
        s, n, at = "".join(map(chr, model.symbols(model._points(text)))), 0, 0
        while at < len(s):
            size = 1
            while at + size < len(s) and s[at : at + size + 1] in learned:
                size += 1
            n, at = n + 1, at + size
        want.append(n)
    return want


def test_phrases_are_a_plain_greedy_parse():
    r = np.random.default_rng(1)
    words = {k: ["".join(chr(c) for c in r.integers(a, b, r.integers(2, 8))) for _ in range(200)] for k, (a, b) in {"aa": (97, 123), "gr": (945, 970), "zh": (0x4E00, 0x6000)}.items()}
    text = lambda k, n: " ".join(r.choice(words[k], n))
    learned = [text(k, 400) for k in words]
    model = langid.Model(list(words), learned, chars=3000)
    model.learned = ["".join(map(chr, model.symbols(model._points(x))[:3000])) for x in learned]
    texts = [text(k, n) for k in words for n in (1, 30, 300)] + [text("aa", 900) + text("zh", 900) + text("aa", 1500), "", "12 !"]
    assert max(map(len, texts)) > 10_000
    got, _, letter = model.phrases(texts)
    for x, own in zip(texts, got.tolist(), strict=True):
        assert own == greedy(model, x), x[:40]
    assert model.predict(texts)[0][:9] == ["aa"] * 3 + ["gr"] * 3 + ["zh"] * 3
    assert letter[-2:].tolist() == [False, False]


def test_every_language_is_learned(spark):
    names = [f"l{i:03d}" for i in range(80)]
    r = np.random.default_rng(2)
    own = {k: ["".join(chr(c) for c in r.integers(0x4E00 + 40 * i, 0x4E40 + 40 * i, 4)) for _ in range(20)] for i, k in enumerate(names)}
    rows = [(j * 100 + i, " ".join(r.choice(own[k], 25)), k) for i, k in enumerate(names) for j in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict_language(docs, langid.train(docs)).join(docs, "doc_id").where("held_out").collect()
    assert len({x["lang_pred"] for x in got}) > 70 and np.mean([x["lang"] == x["lang_pred"] for x in got]) > 0.9


def test_quality_score_is_the_gated_attention(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels, most=300)
    p = {k: v.astype(float) for k, v in model.p.items()}
    rows = docs.limit(40).select("doc_id", "text").collect()
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(spark.createDataFrame(rows), model).collect()}
    for r in rows:
        x, _ = quality.passages(pa.array([r["text"]], pa.string()))
        codes = [np.tanh(np.clip((v - model.mean) * model.scale, -6, 6) @ p["E"] + p["e"]) for v in x]
        gate = [sum(p["w"][i] * math.tanh(e @ p["V"][:, i]) / (1 + math.exp(-(e @ p["U"][:, i]))) for i in range(quality.HIDDEN)) for e in codes]
        share = np.exp(np.array(gate) - max(gate))
        pooled = sum(s * e for s, e in zip(share / share.sum(), codes, strict=True))
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-float(pooled @ p["c"] + p["b"][0]))), abs=1e-4)


def test_passages_do_not_depend_on_other_rows():
    texts = ["  lead and trail  ", None, " \n", "", "one", "a b " * 300, "\tx"]
    x, first = quality.passages(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert np.array_equal(x[first[i] : first[i + 1]], quality.passages(pa.array([t], pa.string()))[0])


def test_training_bags_are_bounded():
    text = " ".join(f"w{i}" for i in range(64 * 500))
    (batch,) = list(quality._encode(64, 10)([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})]))
    assert len(batch.column("bag")[0].as_py()) == 10 * 4 * quality.WIDTH


def labelled(n, hosts, seed):
    """Urls whose long, digit-ridden query marks them, on any host."""
    r = np.random.default_rng(seed)
    for _ in range(n):
        bad = int(r.random() < 0.3)
        path = "/".join("".join(r.choice(list("abcdefgh0123456789" if bad else "abcdefghijklmnop"), r.integers(3, 9))) for _ in range(r.integers(1, 4)))
        query = "?" + "&".join(f"q{i}={r.integers(10**6)}" for i in range(r.integers(3, 6))) if bad else ""
        yield f"http://{r.choice(hosts)}.example.com/{path}{query}", bad


def test_trees_on_held_out_hosts():
    model = urls.Model(list(labelled(1500, [f"h{i}" for i in range(40)], 1)))
    rows = list(labelled(500, [f"k{i}" for i in range(40)], 2))
    got = model.unwanted([u for u, _ in rows]) >= 0.5
    assert np.mean(got == [bool(y) for _, y in rows]) > 0.95
    # each tree by hand
    x = np.array([urls.lexical(u, model.stats, model.prior) for u, _ in rows[:50]], float)
    for row, p in zip(x, model.unwanted([u for u, _ in rows[:50]]), strict=True):
        f = model.trees.base
        for feature, cut, value in model.trees.trees:
            node = 0
            while feature[node] >= 0:
                j = feature[node]
                node = 2 * node + 1 + (sum(e < row[j] for e in model.trees.edges[j]) > cut[node])
            f += value[node]
        assert p == pytest.approx(1 / (1 + math.exp(-f)))


def test_labels_come_from_the_page(spark):
    full, thin = "<p>" + "many good words " * 40, "<div><a href=x></a></div>" * 40 + "<p>few"
    rows = [(1, "http://a.com/1", full), (2, "http://a.com/2", thin), (3, None, thin), (4, "u", None)]
    got = urls.page_labels(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {(r["url"], r["label"]) for r in got} == {("http://a.com/1", 0), ("http://a.com/2", 1), ("u", 1)}


def test_verdicts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = urls.Model(list(labelled(400, ["a"], 3)))
    got = urls.judge(pages, urls.Rules(queries.URL_RULES), model).join(pages.select("page_id", "url"), "page_id").collect()
    seen = set()
    for r in got:
        _, mark, rest = r["url"].partition("://")
        host = rest.split("/")[0].split("?")[0].split("#")[0].lower() if mark else ""
        path = rest[len(host) :].split("?")[0].split("#")[0] if mark else ""
        fits = [(len(rule), rule, v) for v, rule in queries.URL_RULES if ("." + host).endswith("." + rule.split("/")[0]) and path.startswith(rule[rule.index("/") :])]
        want = max(fits)[1:] if fits else (None, "block" if r["unwanted"] >= 0.5 else "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *want)
        seen.add((r["rule"], r["verdict"]))
    assert len(seen) > 3


def test_stored_texts(spark):
    texts = [None, "", "a", "ü" * 50, "x" * 64, "y " * 5000, "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in jpeg.store_texts(docs, media=True).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\0" * (64 * max(1, -(-len(raw) // 64)) - len(raw))
        r = got[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        file = bytes(r["media"])
        assert (r["media_bytes"], r["media_sha256"]) == (len(file), hashlib.sha256(file).hexdigest())
        assert jpeg.read_payload(jpeg.decode(file)) == payload and file[:2] == b"\xff\xd8" and b"\xff\xc2" in file
        assert r["feature"] == jpeg.features(jpeg.decode(file).rgb())
    assert got[2].asDict() | {"doc_id": 6} == got[6].asDict()
    # the stored column is what is read: another file in it gives another result
    swapped = jpeg.encode_texts(docs).withColumn("media", F.lit(jpeg.encode_payload(b"z" * 64)))
    assert {r["payload_sha256"] for r in jpeg.read_texts(swapped).collect()} == {hashlib.sha256(b"z" * 64).hexdigest()}


def test_stored_texts_are_colour_files_with_halved_chroma(spark):
    """op7's tensors against a plain transform of the payload's blocks: four of Y, one of Cb, one of Cr an MCU."""
    r = np.random.default_rng(5)
    texts = ["", "Grün, blau. " * 40, "".join(map(chr, r.integers(1, 900, 30000)))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wave = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (0.5 if u else 0.125**0.5) for x in range(8)] for u in range(8)])
    places = sorted(((i, j) for i in range(8) for j in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    for row in jpeg.store_texts(docs, media=True).collect():
        file, payload = bytes(row["media"]), jpeg.padded(texts[row["doc_id"]].encode())
        frame = jpeg.decode(file)
        assert [(c.h, c.v) for c in frame.parts] == [(2, 2), (1, 1), (1, 1)]
        mcus = frame.mh * frame.mw
        raw = np.frombuffer(payload + bytes(384 * mcus - len(payload)), np.uint8).astype(int).reshape(mcus, 6, 64)
        want = np.zeros((frame.height, frame.width, 3))
        for k, mcu in enumerate(raw):
            six = []
            for block in mcu:
                coef = np.zeros((8, 8))
                for place, b in zip(places, block, strict=True):
                    coef[place] = b if b < 128 else b - 256
                six.append(np.clip(np.rint(wave.T @ coef @ wave + 128), 0, 255))
            y = np.block([[six[0], six[1]], [six[2], six[3]]])
            cb, cr = (np.kron(x - 128, np.ones((2, 2))) for x in six[4:])
            top, left = 16 * (k // frame.mw), 16 * (k % frame.mw)
            want[top : top + 16, left : left + 16] = np.dstack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb])
        got = frame.rgb().astype(int)
        assert (got[..., 0] != got[..., 2]).any() == bool(texts[row["doc_id"]])  # zeros are grey
        assert (np.abs(got - np.clip(np.rint(want), 0, 255)) > 0).mean() < 0.001  # single against double precision
        assert row["feature"] == jpeg.features(frame.rgb()) and row["feature"].startswith(f"{frame.height}x{frame.width};")


def _payloads():
    r = np.random.default_rng(6)
    for n in (1, 5, 6, 7, 130):
        raw = r.integers(0, 256, 64 * n, dtype=np.uint8)
        yield raw
        yield np.where(r.random(64 * n) < 0.97, 0, raw)  # runs of over 16 zeros, empty blocks
        yield r.choice(np.array([0, 1, 255, 2, 254], np.uint8), 64 * n)  # known, new and no coefficients in refinements
        yield np.where(np.arange(64 * n) < 21 * n, 65 + raw % 26, 0)  # text, then nothing
        yield np.zeros(64 * n, np.uint8)


def test_scans_have_units_of_many_lengths(monkeypatch):
    """Stored files against decoding bit by bit; also with short ends of band and small pieces."""
    payloads = [p.astype(np.uint8).tobytes() for p in _payloads()]
    files = jpeg.encode_payloads(payloads)
    assert files == [jpeg.encode_payload(p) for p in payloads]
    frames = [jpeg.decode(f) for f in files]
    assert [jpeg.read_payload(f) for f in frames] == payloads
    monkeypatch.setattr(jpeg, "_PIECE", 16)
    cut = [jpeg.decode(f) for f in files]
    monkeypatch.setattr(jpeg, "_LONGEST", 3)
    assert [jpeg.read_payload(jpeg.decode(f)) for f in jpeg.encode_payloads(payloads)] == payloads
    monkeypatch.setattr(jpeg, "_BLOCKS", 7)
    assert [jpeg.read_payload(jpeg.decode(f)) for f in jpeg.encode_payloads(payloads)] == payloads
    met = set()
    symbol = jpeg._Bits.symbol
    monkeypatch.setattr(jpeg._Bits, "symbol", lambda self, table: met.add(got := symbol(self, table)) or got)
    monkeypatch.setattr(jpeg, "_scan", jpeg._by_bits)
    for file, frame, again in zip(files, frames, cut, strict=True):
        for a, b, c in zip(frame.parts, again.parts, jpeg.decode(file).parts, strict=True):
            assert np.array_equal(a.coef, c.coef) and np.array_equal(b.coef, c.coef)
    assert {0x00, 0x10, 0xF0, 0x01, 0x11} <= met and len(met) > 50  # ends of one and of more bands, 16 zeros, new ones


def test_damaged_files_are_refused_or_read():
    file, r = bytearray(jpeg.encode_payload(bytes(range(256)) * 9)), np.random.default_rng(7)
    for _ in range(300):
        bad = bytearray(file)
        bad[r.integers(250, len(bad))] ^= 1 << r.integers(8)
        try:
            jpeg.decode(bytes(bad[: r.integers(250, len(bad) + 1)])).rgb()
        except (ValueError, IndexError, KeyError, struct.error):
            pass
