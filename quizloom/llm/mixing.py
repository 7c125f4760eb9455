"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source with share w of the target mass and m of the present mass gets the mean repetition rate
``epochs * w * total / m``. Each document draws its number of copies from the Poisson distribution of that mean, by
inverting it at a uniform number hashed from its key, so a rerun on any cluster draws the same. Copies are put in a
global order by another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import Scratch

#: A larger mean is split into equal parts of at most this, whose draws add up.
PART_MEAN = 16
#: Terms of the distribution that are tabulated; beyond them lies less than 2 ** -52.
TERMS = 80
#: Up to so many sources are broadcast with their tables, under 10 MB; more are joined by salted keys.
BROADCAST_SOURCES, SALTS = 10_000, 64


def uniform(*parts: Column | str) -> Column:
    """52 bits of SHA-256 of the parts (null as empty, joined by a bar), as a number from 0 up to 1."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string") if isinstance(p, Column) else F.lit(p), F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def repetition_rates(docs: DataFrame, weights: Mapping[str, float] | None, epochs: float, source: str, text: str) -> DataFrame:
    """source, rate for each source; the mass of a document is its characters and one for its end.

    Without ``weights`` a source weighs the square root of its mass. Sources that ``weights`` lacks weigh 0; null is a source of its own,
    which only the square root gives a weight.
    """
    mass = docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.coalesce(F.length(text), F.lit(0)) + 1).cast("double").alias("mass"))
    if weights is None:
        weight = F.sqrt("mass")
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), "source"), F.lit(0.0)) if pairs else F.lit(0.0)
    mass = mass.withColumn("weight", weight)
    total = mass.agg(F.sum("mass").alias("total"), F.sum("weight").alias("weights"))
    rate = F.lit(float(epochs)) * (F.col("weight") / F.nullif("weights", F.lit(0.0))) * F.col("total") / F.col("mass")
    return mass.join(F.broadcast(total)).select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0, seed: str = "mix-1", key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as drawn, with copy_no (from 1) and shuffle_key, in ascending order of shuffle_key.

    Rows with equal keys draw equally, repeated ones too, and share their shuffle keys; a row without key draws by the digest of its text. An empty table gives none, a null text has no characters. A rate of 0 gives no copies. Columns of ``docs`` named copy_no or
    shuffle_key are replaced, all others are kept.
    """
    spark = docs.sparkSession
    docs = docs.drop("copy_no", "shuffle_key")
    scratch = Scratch(spark, "mixing")
    rates = scratch.save(repetition_rates(docs, weights, epochs, source, text), "rates")
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    rates = rates.withColumn("__parts", parts).withColumn("__mean", F.col("rate") / F.col("__parts"))
    term = F.struct(F.exp(-F.col("__mean")).alias("p"), F.array(F.exp(-F.col("__mean"))).alias("cdf"))
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), term, lambda a, k: next_term(a, k), lambda a: a["cdf"])
    rates = rates.select(F.col("source").alias("__source"), "__parts", grown.alias("__cdf"))
    if rates.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(rates), docs[source].eqNullSafe(F.col("__source")))
    else:
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        docs = docs.withColumn("__own", F.pmod(F.xxhash64(key, text), F.lit(SALTS)).cast("int"))
        joined = docs.join(salted, docs[source].eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__salt"))).drop("__own", "__salt")
    own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    drawn = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda j: uniform(seed, own, j))  # one hash for each draw
    copies = F.aggregate(drawn, F.lit(0), lambda n, u: n + F.size(F.filter("__cdf", lambda c: c <= u)))
    out = joined.withColumn("copy_no", F.explode(F.sequence(F.lit(0), copies))).where("copy_no > 0").drop("__source", "__parts", "__cdf")
    order = F.substring(F.sha2(F.concat_ws("|", F.lit(f"{seed}-order"), own, F.col("copy_no").cast("string")), 256), 1, 16)
    return out.withColumn("shuffle_key", order).orderBy("shuffle_key")


def next_term(a: Column, k: Column) -> Column:
    p = a["p"] * F.col("__mean") / k
    return F.struct(p.alias("p"), F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + p)).alias("cdf"))


MIX_SQL = """
WITH mass AS (SELECT source, CAST(sum(coalesce(length(text), 0) + 1) AS DOUBLE) AS mass FROM documents GROUP BY source),
total AS (SELECT sum(mass) AS total, sum(sqrt(mass)) AS weights FROM mass),
rate AS (SELECT source, 1.0::DOUBLE * (sqrt(mass) / weights) * total / mass AS rate FROM mass, total),
part AS (SELECT *, greatest(CAST(ceil(rate / 16) AS INT), 1) AS parts, rate / greatest(CAST(ceil(rate / 16) AS INT), 1) AS mean FROM rate),
cdf AS (SELECT source, parts, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
        FROM part, (SELECT unnest(range(0, 81)) AS k)),
draw AS (SELECT rowid_, j, (CAST('0x' || substr(sha256('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || sha256(coalesce(text, ''))) || '|' || j), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE) AS u, d.source
         FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) d JOIN part p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(range(1, parts + 1)) AS j)),
copies AS (SELECT rowid_, count(*) AS n FROM draw JOIN cdf ON draw.source IS NOT DISTINCT FROM cdf.source AND cdf.cdf <= draw.u GROUP BY rowid_)
SELECT doc_id, text, lang, d.source, n_chars, CAST(copy_no AS INT) AS copy_no,
       substr(sha256('mix-1-order|' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || sha256(coalesce(text, ''))) || '|' || copy_no), 1, 16) AS shuffle_key
FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) d JOIN copies USING (rowid_), LATERAL (SELECT unnest(range(1, n + 1)) AS copy_no)
"""
