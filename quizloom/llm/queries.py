"""The driver queries of this package and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.llm import bpe, bsi_topk, fingerprint, hard_negatives, lang_id, licenses, minhash, mixing, periodic, quality, quotes, substring_dedup, token_counts


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", lang_id.held_out().alias("held_out"))
    model = lang_id.train(docs.where("NOT held_out").select("doc_id", "text", "lang"))
    return lang_id.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bsi_topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.thread(table(spark, sf_dir, "conversations")).drop("text")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.drop_repeats(docs, rewrite=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        licenses.labels(F.col("spans"), base=True).alias("base_labels"), licenses.labels(F.col("spans")).alias("labels"), licenses.score(F.col("spans")).alias("score"),
    )


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the documents, by a hash of their id, with a tail that repeats its beginning; without id a text stays as it is."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=repeated_tail)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    found = found.withColumn("longest", longest)
    length, start, period = F.col("longest.length"), -F.col("longest.col2"), -F.col("longest.col3")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label"))
    return hard_negatives.mine(vectors, lambda i: i % 50 == 0)


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

REPEATS_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
win AS (SELECT r, doc_id, i, md5(array_to_string(words[i:i+12], ' ')) AS h
        FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
first AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM win JOIN first USING (h) WHERE d < doc_id),
word AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""
NEAR_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i+3], ' ')) END) AS shingles FROM w),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS h FROM s),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS shared FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common WHERE 100 * shared >= 80 * (nx + ny - shared)),
side AS (SELECT x AS a, y AS b FROM link UNION SELECT y, x FROM link),
reach AS (WITH RECURSIVE walk AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT walk.a, side.b FROM walk JOIN side ON walk.b = side.a)
          SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN reach USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_bpe, op3_fingerprints, op4_quality, op5_exact_topk, op6_token_counts, op7_mixing, op8_quotes, op9_substrings, op10_near_duplicates, op11_licenses, op12_periodic_runs, op13_hard_negatives)
}
ORACLE_SQL: dict[str, str] = {
    "op5_exact_topk": TOPK_SQL,
    "op7_mixing": mixing.MIX_SQL,
    "op8_quotes": quotes.QUOTES_SQL,
    "op9_substrings": REPEATS_SQL,
    "op10_near_duplicates": NEAR_SQL,
    "op11_licenses": licenses.license_sql(),
    "op13_hard_negatives": NEGATIVES_SQL,
}
