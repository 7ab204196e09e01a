"""The registered queries: each applies one operator to its whole table and
derives the digest columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import alignment, langid, licenses, minhash, mixing, packing, pieces, quotient, secrets, substring, tokencount, topk, whitening
from orrery.llm.util import documents
from orrery.sources.tables import table_path


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text again."""
    model = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = documents(spark, sf_dir).select("doc_id", "text", pieces.coder(model)("text").alias("both"))
    return docs.select("doc_id", F.size("both.ids").cast("long").alias("n_ids"), "both.ids",
                       (F.col("both.text") == F.coalesce("text", F.lit(""))).alias("restored"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.classify(docs, langid.fit(docs))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(documents(spark, sf_dir), shingle=4, percent=80)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), packing.load(public_tokenizers.path("word_bpe_49k.json")))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient.exact_dedup(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(table_path(sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir))
    base = found.withColumn("base", F.filter("spans", lambda s: s["place"] < len(secrets.BASE)))

    def count(place: int) -> Column:
        return F.size(F.filter("base", lambda s: s["place"] == place)).cast("long")

    return base.select(
        "doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(secrets.BASE)],
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir), pieces.load(public_tokenizers.path("piece_bpe_32k.model")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(table_path(sf_dir, "embeddings")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(documents(spark, sf_dir), packing.load(public_tokenizers.path("byte_bpe_50k.json")),
                                     pieces.load(public_tokenizers.path("piece_bpe_32k.model")))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return mixing.score_documents(docs, mixing.fit(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


_SPACE = r"'[\x20\x09-\x0D]'"

_WORD = r"'[^\x20\x09-\x0D]+'"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_ORACLES = {
    "op3_minhash_near_dedup": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), {_WORD}) AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                               ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, ways.b FROM r JOIN ways ON ways.a = r.reached),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c USING (doc_id)""",
    "op6_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
f AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN f USING (k) WHERE doc_id > first_id),
each AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op7_exact_top_k": """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
s AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.v::DOUBLE[], p.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10""",
    "op5_exact_dedup": f"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), {_SPACE}, '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
