"""Every corpus operator on the awkward table, and each against brute force or a property that fixes its result."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from meterline.llm import fingerprint, html, jpeg, langid, mixing, near, packing, quality, queries, sample, substring, urls
from meterline.llm.words import Words

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, score double, hits string, component_id string, d string"
LONG = " ".join(f"wort{i % 977} ünd" for i in range(30_000))
TEXTS = [None, "", "   \n\t ", "one", "A b c d e f", "a B c d e f", LONG, LONG + " tail", "x" * 100_000, "tab\tand nbsp   wide end ", "12 34 !!", "a <|endoftext|> b", "word " * 50]


def awkward(spark, n=None):
    rows = [(i if i else None, t, [None, "en", "de"][i % 3], [None, "src1", "src7"][i % 3], i, 1, 0.5, "h", "c", "d") for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", "src1", 0, 1, 0.5, "h", "c", "d")] * 2
    return spark.createDataFrame(rows[:n] if n is not None else rows, DOCS)


def words(text):
    import re

    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


OPERATORS = {
    "fingerprint": lambda d: fingerprint.successor_fingerprints(d),
    "near": lambda d: near.near_duplicates(d),
    "packing": lambda d: packing.pack(d, BPE),
    "quality": lambda d: quality.quality_scores(d, quality.fit([], np.zeros(0))),
    "media": lambda d: jpeg.store_texts(d),
    "language": lambda d: langid.predict_language(d, langid.train(d)),
    "substring": lambda d: substring.substring_dedup(d),
    "mixing": lambda d: mixing.mix(d, {}, F.lit("x")),
    "html": lambda d: html.extract(d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.col("text").alias("url"), "n_chars")),
    "urls": lambda d: urls.judge(d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.lit("x").alias("host")), urls.Rules(queries.URL_RULES), urls.Model([])),
    "without_near": lambda d: near.without_near_duplicates(d),
    "without_repeats": lambda d: substring.without_repeats(d),
    "keep_good": lambda d: quality.keep_good(d, quality.fit([], np.zeros(0))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows(spark, name):
    """Row counts, and equal rows for what must be equal: rows that repeat both id and text."""
    got = OPERATORS[name](awkward(spark)).collect()
    if name == "packing":
        assert len({(r["doc_id"], r["piece"]) for r in got}) == len({(r["doc_id"], r["piece"], r["ids_crc32"]) for r in got})
    elif not name.startswith("without"):
        assert len(got) == len(TEXTS) + 2
        own = "page_id" if name in ("html", "urls") else "doc_id"
        same = {tuple(map(str, r.asDict().values())) for r in got if r[own] == 4}
        assert len(same) == 1 or name in ("fingerprint", "keep_good", "mixing")  # a successor is the next row; all columns are kept


def test_awkward_values(spark):
    """Nulls, empty and wordless texts, ties and a very long text."""
    by = lambda df, key="doc_id": {r[key]: r for r in df.collect()}
    got = by(near.near_duplicates(awkward(spark)))
    assert [got[k]["n_shingles"] for k in (None, 1, 2, 3, 4, 5, 8, 12)] == [0, 0, 0, 1, 2, 2, 1, 1]
    assert [(got[k]["component_id"], got[k]["kept"]) for k in (4, 5, 6, 7)] == [(4, True), (4, False), (6, True), (6, False)]
    cut = by(substring.substring_dedup(awkward(spark)))
    assert [(cut[k]["n_words"], cut[k]["n_removed"]) for k in (None, 1, 2, 8, 12)] == [(0, 0), (0, 0), (0, 0), (1, 0), (50, 49)]
    assert cut[6]["n_words"] == 60_000 and cut[7]["n_removed"] == 60_000 and cut[7]["kept_sha256"] == hashlib.sha256(b"tail").hexdigest()
    lang = by(langid.predict_language(awkward(spark), langid.train(awkward(spark))))
    assert [(lang[k]["lang_pred"], lang[k]["score"]) for k in (None, 1, 2, 10)] == [("und", 0.0)] * 4 and lang[6]["lang_pred"] in ("en", "de")
    marks = by(quality.quality_scores(awkward(spark), quality.fit([], np.zeros(0))))
    assert {r["score"] for r in marks.values()} == {0.5} and not marks[None]["held_out"]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](awkward(spark, 0)).count() == 0


def brute_near(rows, percent):
    sets = {}
    for k, t in rows:
        w = words((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    top = {k: k for k in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_against_brute_force(spark, percent):
    r = np.random.default_rng(percent)
    rows, k = [], 0
    for _ in range(12):
        base = [f"w{x}" for x in r.integers(0, 500, 120)]
        for _ in range(10):
            w = list(base)
            for j in r.integers(0, len(w), r.integers(0, 6)):
                w[j] = f"n{r.integers(0, 10**6)}"
            rows.append((k, " ".join(w)))
            k += 1
    rows += [(k, ""), (k + 1, None), (k + 2, "A b"), (k + 3, "a B")]
    want = brute_near(rows, percent)
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == want
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in got)


def test_substring_against_brute_force(spark):
    r = np.random.default_rng(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for k in range(40):
        w = [f"w{x}" for x in r.integers(0, 30, r.integers(0, 80))]
        if k % 3 == 0:
            at = int(r.integers(0, len(w) + 1))
            a, b = sorted(r.integers(0, 61, 2).tolist())
            w[at:at] = passage[a:b]
        if k % 7 == 0:
            w += ["same"] * int(r.integers(0, 70))
        rows.append((k, "  ".join(w) if k % 2 else "\n".join(w)))
    rows += [(100, rows[0][1]), (101, None)]
    seen, want = set(), {}
    for k, t in sorted(rows):
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            g = tuple(w[i : i + 20])
            if g in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(g)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[k] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    got = substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_sha256"]) for x in got} == want
    assert all(sum(b - a for a, b in x["spans"]) == x["n_removed"] for x in got)


def test_packing_is_gapless_and_exact(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    docs = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = packing.pack(docs, BPE).collect()
    by = {}
    for x in got:
        by.setdefault(x["doc_id"], []).append(x)
    for d in docs.collect():
        ids = np.array([*t.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by[d["doc_id"]], key=lambda x: x["piece"])
        assert [x["length"] for x in own[1:]] == [2048] * (len(own) - 1) and sum(x["length"] for x in own) == len(ids)
        for x in own:
            assert zlib.crc32(ids[x["start"] : x["start"] + x["length"]].tobytes()) == x["ids_crc32"]
    at = {}
    for x in sorted(got, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == at.get(x["sequence_id"], 0)
        at[x["sequence_id"]] = x["offset"] + x["length"]
    assert max(at.values()) <= 2048


def test_bin_kinds_are_fullest():
    r = np.random.default_rng(2)
    for _ in range(20):
        counts = dict(Counter(r.integers(1, 60, 25).tolist()))
        kind = packing.fullest(counts, sorted(counts), 100)
        reach = {0}
        for length, n in counts.items():
            reach |= {s + i * length for s in reach for i in range(n + 1)}
        assert sum(k * v for k, v in kind.items()) == max(s for s in reach if s <= 100)
        assert all(v <= counts[k] for k, v in kind.items())
        used = Counter()
        for times, kind in packing.plan(counts, 100):
            used.update({k: v * times for k, v in kind.items()})
        assert used == counts


def test_fingerprints(spark):
    rows = [(i, " ".join(f"w{(i * 37 + j * j) % 1009}" for j in range(40 + 13 * i))) for i in range(60)]
    got = sorted(fingerprint.successor_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    for i, x in enumerate(got):
        t, nxt = rows[i][1], rows[(i + 1) % 60][1]
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        assert x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and x["n_chars"] == len(t)
        a, b, c = (set(fingerprint.Digests(_col([s])).key.tolist()) for s in (t, edited, nxt))
        assert x["near_edited"] == pytest.approx(len(a & b) / len(a | b)) and x["near_next"] == pytest.approx(len(a & c) / len(a | c))


def _col(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_media_round_trip_and_general_decoder(spark, monkeypatch):
    r = np.random.default_rng(1)
    for n in (1, 3, 40):
        raw = r.integers(0, 256, 64 * n, dtype=np.uint8).tobytes()
        file = jpeg.encode_payload(raw)
        fast = jpeg.decode(file)
        assert jpeg.read_payload(fast) == raw
        with monkeypatch.context() as m:
            m.setattr(jpeg.Huffman, "unit", lambda self, dc: None)
            slow = jpeg.decode(file)
        assert np.array_equal(fast.parts[0].coef, slow.parts[0].coef)
    got = jpeg.store_texts(awkward(spark), media=True)
    rgb = jpeg.decode_media(got.select("media", "doc_id")).collect()
    assert all(len(x["rgb"]) == x["height"] * x["width"] * 3 for x in rgb)


def test_chroma_is_upsampled():
    f = jpeg.Frame()
    f.start(bytes([8, 0, 16, 0, 16, 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    f.tables[0] = np.ones(64, np.int32)
    f.parts[2].coef[0, 0, 0] = 8 * 50  # red difference of 50 everywhere
    rgb = f.rgb()
    assert rgb.shape == (16, 16, 3) and set(map(tuple, rgb.reshape(-1, 3))) == {(198, 92, 128)}


def test_html():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="ad">Buy now</div>
<article><header><h1>The &amp; title</h1></header><p>First   <b>bold</b>
text that is long enough to be content.<br>more</p><p>Of.</p><aside>side</aside><form><input><label>name</label></form>
<div id="comments"><p>reader says</p></div><p>Caf&eacute; &#8364;5</p></article><div class="cookie-notice">We use cookies</div><footer>&copy; x</footer>"""
    assert html.main_text(page) == "The & title\nFirst bold text that is long enough to be content. more\nOf.\nCafé €5"
    plain = "<body><div class=menu>a b</div><div><p>" + "long words here " * 20 + "</p><p>tail</p></div><div><a href=x>y</a></div></body>"
    assert html.main_text(plain).endswith("\ntail")


def test_url_rules():
    rules = urls.Rules(queries.URL_RULES)
    for url, want in [("http://A.Example.com/en/7817?x=1", ("example.com/en/7", "allow")), ("https://x.com/en/8", ("com/en/", "block")), ("http://notcom/en/", None), ("http://com/en/", ("com/en/", "block")), ("x", None), (None, None), ("http://a.example.net/de/81", ("example.net/de/8", "block")), ("http://a.example.net/de", None)]:
        assert rules.match(*urls.parts(url)) == want
    assert urls.parts("http://HÖST.com:80/a?b#c") == ("hÖst.com:80", "/a")


def test_sample_is_the_smallest_hashes(spark):
    rows = spark.range(5000).selectExpr("id div 2 as doc_id", "1 as quality").repartition(7)
    want = [r[0] for r in rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(300).collect()]
    assert [r["doc_id"] for r in sample.smallest(rows, "doc_id", 300)] == want
    assert len(sample.smallest(rows, "doc_id", 4000)) == 2500
    assert sample.smallest(rows.limit(0), "doc_id", 5) == []


def test_budgets():
    r = np.random.default_rng(3)
    for _ in range(200):
        room, weight = r.integers(0, 50, 6).tolist(), r.integers(0, 5, 6).tolist()
        budget = int(r.integers(0, 200))
        got = mixing.deal(budget, room, weight)
        assert sum(got) == min(budget, sum(room)) and all(0 <= g <= m for g, m in zip(got, room, strict=True))
    leaves = [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 1000), ("b", "x", "4", 1000)]
    # the small source's shortage goes to its sibling, not to the other language or domain
    assert mixing.budgets(leaves, {}, 400, 1) == [10, 90, 100, 200]


def test_mixing_takes_seeded_prefixes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs, {}, F.lit("d"), budget=0.5, epochs=2).select("doc_id", "lang", "source", "tokens_", "epochs_", "partial_", "taken_", F.xxhash64(F.lit(1), F.col("epochs_"), F.col("doc_id").cast("string")).alias("h")).collect()
    leaves = {}
    for x in got:
        leaves.setdefault(("d", x["lang"], x["source"]), []).append(x)
    order = sorted(leaves)
    share = mixing.budgets([(*k, sum(x["tokens_"] for x in leaves[k])) for k in order], {}, int(sum(x["tokens_"] for x in got) * 0.5), 2)
    for k, b in zip(order, share, strict=True):
        own = sorted(leaves[k], key=lambda x: x["h"])
        total, upto = sum(x["tokens_"] for x in own), 0
        for x in own:
            assert x["partial_"] == (upto < b % total) and x["epochs_"] == b // total
            upto += x["tokens_"]


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    got = langid.predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([x["lang"] == x["lang_pred"] for x in got]) > 0.97
    a = langid.Automaton(np.array([0, 1, 0, 2, 0, 1, 1]), 3)
    for sub in ([0, 1, 0], [2, 0, 1, 1], [1, 1]):
        s = 0
        for c in sub:
            s = a.table[s, c]
        assert s >= 0
    assert a.table[a.table[0, 2], 2] == -1


def test_quality_separates(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([x["score"] for x in got if x["quality"] == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9


def test_words_match_the_pattern():
    texts = [t or "" for t in TEXTS]
    w = Words(_col(texts))
    assert [w.data[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)] == [x for t in texts for x in words(t)]
    assert np.diff(w.first).tolist() == [len(words(t)) for t in texts]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    from oracle import same

    same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF)
