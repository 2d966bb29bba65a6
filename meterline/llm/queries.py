"""The registered queries of the corpus operators, over whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import fingerprint, html, jpeg, langid, mixing, near, packing, quality, substring, urls
from meterline.llm.sample import within
from meterline.plans.cluster import Scratch

# Fixed values of the URL query: (verdict, rule).
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
# Fixed values of the mixing query: target weights by (domain,) and (domain, language); absent ones count 1.
MIX_WEIGHTS: dict[tuple, float] = {("group0",): 4, ("group1",): 3, ("group2",): 2, ("group3",): 1} | {(f"group{i}", x): w for i in range(4) for x, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def domain() -> Column:
    """The documents' domain: their source's number in groups of five."""
    return F.concat(F.lit("group"), F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) div 5").cast("string"))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.successor_fingerprints(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), MIX_WEIGHTS, domain(), budget=0.6, epochs=2)
    return got.select("doc_id", F.col("domain_").alias("domain"), "lang", "source", F.col("tokens_").alias("n_tokens"), F.col("epochs_").alias("epochs"), F.col("partial_").alias("partial"), F.col("taken_").alias("taken_tokens"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.store_texts(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labels = Scratch(spark, "urls").keep(urls.page_labels(within(pages, "url", urls.SAMPLE)), "labels")
    return urls.judge(pages, urls.Rules(URL_RULES), urls.train(labels))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_language(docs, langid.train(docs))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_near_dedup, op3_packing, op4_quality, op5_main_text, op6_mixing, op7_media, op8_url_filter, op9_language, op10_substring_dedup)
}

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
r(doc_id, top) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.top FROM r JOIN l ON l.a = r.doc_id),
c AS (SELECT doc_id, min(top) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
""",
    "op10_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM g) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM d),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
}
