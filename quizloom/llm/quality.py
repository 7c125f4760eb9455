"""Quality selection by importance resampling.

Two generative models of hashed word n-grams, of the target (rows labelled good) and of the raw text (all rows), give each
document the logarithm of its importance weight: the sum of log-ratios over its n-grams. Adding Gumbel noise hashed from its key and
taking the k highest is a weighted sample without replacement.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import Scratch
from quizloom.llm.mixing import uniform

BUCKETS = 1 << 14
#: Rows labelled good that the target model is fitted on, about so many drawn by hash; their ids are broadcast.
TARGET_ROWS = 20_000
#: A boundary range of this size is sorted.
SORTED = 20_000


def ngram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the lower-cased words and of their neighbouring pairs; null and empty texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.flatten(F.transform(F.array(hashed), lambda h: F.concat(
        F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int")),
        F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int")),
    )))


def model(texts: DataFrame, buckets: int) -> list[float]:
    """Log-probability of each bucket, with one added to each count."""
    counted = texts.select(F.explode(ngram_buckets(F.col("text"), buckets)).alias("b")).groupBy("b").count()
    n = [1] * buckets
    for r in counted.toLocalIterator():  # at most a row for each bucket
        n[r.b] += r["count"]
    total = math.log(sum(n))
    return [math.log(x) - total for x in n]


def kth_boundary(df: DataFrame, column: str, k: int) -> tuple[float | None, float | None]:
    """A range above lo and up to hi that holds the k-th highest value of ``column``; (None, None) is all of them.

    Narrowed by quantiles, with counts over all rows, until it is short enough to sort or holds one value.
    """
    lo, hi = None, None
    while True:
        part = df if lo is None else df.where((F.col(column) > F.lit(lo)) & (F.col(column) <= F.lit(hi)))
        n, low, high, cuts = part.agg(F.count("*"), F.min(column), F.max(column), F.percentile_approx(column, [x / 64 for x in range(1, 64)], 2000)).first()
        if n <= SORTED or low == high:
            return lo, hi
        cuts = sorted({*cuts, math.nextafter(high, -math.inf), high})  # so that a top value most rows share is told from those below
        above = df.agg(*[F.count_if(F.col(column) > F.lit(c)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        i = next(i for i, c in enumerate(above) if c < k)
        new = (cuts[i - 1] if i else lo, cuts[i])
        if new[0] is None:
            new = (math.nextafter(low, -math.inf), cuts[i])
        lo, hi = new


def flag_top_k(rows: DataFrame, k: int, score: str, row_id: str) -> DataFrame:
    """Add ``kept``: whether the row is among the k highest scores, ties to the smaller row id."""
    if k <= 0:
        return rows.withColumn("kept", F.lit(False))
    lo, hi = kth_boundary(rows, score, k)
    edge = rows if hi is None else rows.where((F.col(score) > F.lit(lo)) & (F.col(score) <= F.lit(hi)))
    sure = F.lit(False) if hi is None else F.col(score) > F.lit(hi)
    missing = k - (0 if hi is None else rows.where(sure).count())
    n = edge.count()
    if n > SORTED:  # one value
        inner = edge.withColumn("__minus", -F.col(row_id).cast("double"))
        low, high = kth_boundary(inner, "__minus", missing)
        taken = inner.where(F.col("__minus") > F.lit(high)).count() if high is not None else 0
        border = inner if high is None else inner.where((F.col("__minus") > F.lit(low)) & (F.col("__minus") <= F.lit(high)))
        ids = border.orderBy(row_id).limit(missing - taken).select(F.col(row_id).alias("__id"))
        first = F.lit(False) if high is None else (F.col(score) == F.lit(hi)) & (-F.col(row_id).cast("double") > F.lit(high))
        sure = sure | first
    else:
        ids = edge.orderBy(F.desc(score), row_id).limit(missing).select(F.col(row_id).alias("__id"))
    out = rows.join(F.broadcast(ids), rows[row_id] == F.col("__id"), "left")  # at most SORTED ids
    return out.withColumn("kept", sure | F.col("__id").isNotNull()).drop("__id")


def resample(docs: DataFrame, labels: DataFrame, keep: float | None = None, buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, seed: str = "dsir-1", key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, log_weight, gumbel_key, kept for each row of ``docs``; about ``keep`` of all rows are kept, exactly round(keep * rows).

    ``labels`` has the key and quality (1: good). Without ``keep`` it is the share of good rows among the labelled ones (all rows, if there are no labels).
    Null and empty texts weigh 0 in logarithm. Rows with equal keys get equal noise; ties in the sample go by the row's place in a
    written table. Without good rows, the target is the raw text and the sample is uniform. An empty table gives none; other columns of ``docs``, of whatever name, are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    n_labels, n_good = labels.agg(F.count_if(F.col("quality").isNotNull()), F.count_if(F.col("quality") == 1)).first()
    draw = uniform(f"{seed}-target", F.col(key))
    good = labels.where((F.col("quality") == 1) & (draw < min(1.0, target_rows / max(1, n_good)))).select(F.col(key).alias("__key")).distinct()
    good = spark.createDataFrame(good.toArrow()) if n_good else good  # about target_rows ids
    raw = model(source, buckets)
    target = model(source.join(F.broadcast(good), "__key", "left_semi"), buckets) if n_good else raw
    ratio = F.lit([t - r for t, r in zip(target, raw, strict=True)])
    weight = F.aggregate(ngram_buckets(F.col("text"), buckets), F.lit(0.0), lambda a, b: a + F.get(ratio, b))
    noise = -F.log(-F.log(uniform(seed, F.col("__key")) + F.lit(2.0**-53)))
    scored = source.select("__key", weight.alias("log_weight")).withColumn("gumbel_key", F.col("log_weight") + noise)
    scored = scratch.save(scored.withColumn("__row", F.monotonically_increasing_id()), "scored")
    rows = scored.count()
    share = keep if keep is not None else (n_good / n_labels if n_labels else 1.0)
    return flag_top_k(scored, round(share * rows), "gumbel_key", "__row").select(F.col("__key").alias(key), "log_weight", "gumbel_key", "kept")
