"""Language identification.

Sparse multinomial logistic regression on TF-IDF weights of hashed character n-grams (one to three characters),
trained by follow-the-regularised-leader with an elastic net, then calibrated by a temperature on rows kept out of
the training. Document frequencies come from all learning rows; the weights are fitted on a bounded sample of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import give_back, small_batches, thrifty

UNKNOWN = "und"
ORDERS = (1, 2, 3)
#: Starts of n-grams that are hashed at a time; the counts add up.
CHUNK = 1 << 18
#: Bytes of a model's weights: with very many languages it gets fewer buckets, FEWEST_BITS of a hash at least.
MODEL_BYTES, FEWEST_BITS = 256 << 20, 6
#: Odd multipliers of the n-gram hash, one for each place and one that mixes.
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
MIX = 0xD6E8FEB86659FD93


@dataclass
class LangModel:
    langs: list[str]
    idf: np.ndarray  # of each bucket
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        at = np.flatnonzero(counts)
        x = tf_idf(counts[at], self.idf[at])
        z = (x @ self.weights[at] + self.bias) / self.temperature
        p = np.exp(z - z.max())
        k = int(np.argmax(p))
        return self.langs[k], float(p[k] / p.sum())


def is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Counts of hashed character n-grams within words; everything but letters counts as one space."""

    def __init__(self, bits: int):
        self.bits, self.letter = bits, is_letter()

    def __call__(self, text: str | None) -> np.ndarray | None:
        """None if the text is null or has no letter."""
        if not text:
            return None
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letters = self.letter[codes]
        if not letters.any():
            return None
        codes = np.concatenate([[32], np.where(letters, codes, 32), [32]]).astype(np.uint32)
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]  # runs of spaces are one
        total = np.zeros(1 << self.bits, np.int64)
        for n in ORDERS:
            for at in range(0, len(codes) - n + 1, CHUNK):
                part = codes[at : at + CHUNK + n - 1].astype(np.uint64)
                size = len(part) - n + 1
                h = part[:size] * np.uint64(PLACES[0])
                for k in range(1, n):
                    h = (h ^ (h >> np.uint64(29))) * np.uint64(MIX) + part[k : size + k] * np.uint64(PLACES[k])
                h = ((h ^ (h >> np.uint64(32))) * np.uint64(MIX)) >> np.uint64(64 - self.bits)
                total += np.bincount(h.astype(np.int64), minlength=1 << self.bits)
        return total


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf
    return x / np.sqrt((x * x).sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal steps, one row at a time; the l1 part keeps them sparse, the bias is free of both."""
    z, n = np.zeros((2, size + 1, classes))
    rng = np.random.default_rng(seed)

    def solved(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at < size, l1, 0)[:, None], 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + np.where(at < size, l2, 0)[:, None])

    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, size), np.append(x, 1.0)
            w = solved(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = solved(np.arange(size + 1))
    return w[:-1], w[-1]


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature that makes the kept-out labels most likely, by golden-section search on its logarithm.

    The labels are smoothed by one over their number, so that a faultless sample does not make every score 1.
    """
    target = np.full(logits.shape, 1 / (len(y) + 2) / max(1, logits.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - 1 / (len(y) + 2)

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - (z * target).sum(1)).mean())

    lo, hi, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(learning: DataFrame, text: str = "text", lang: str = "lang", bits: int = 15, sample_rows: int = 4000, seed: int = 11) -> LangModel | None:
    """A model from the rows of ``learning`` with text, letters and a language; None if there is no such row.

    ``sample_rows`` bounds the rows that the weights are fitted on to about so many, in equal parts for each language as
    far as it has them, drawn by a hash of the whole row, which may hold an id for that; document frequencies take every row.
    A tenth of the sample goes to the calibration alone. The weights take MODEL_BYTES at most: beyond a thousand languages, n-grams are hashed to fewer than ``bits`` bits.
    """
    small_batches(learning.sparkSession)
    rows = learning.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(*learning.columns, F.lit(seed)).alias("draw"))

    most = MODEL_BYTES >> (FEWEST_BITS + 3)
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(most + 1).collect()}
    if len(sizes) > most:
        raise ValueError(f"more than {most} languages do not fit a model of {MODEL_BYTES} bytes")
    while sizes and (len(sizes) << (bits + 3)) > MODEL_BYTES:
        bits -= 1

    def frequencies(batches):
        grams, total, n = Grams(bits), np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if (c := grams(t)) is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int64()), pa.array([*total[at], n], pa.int64())], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(thrifty(frequencies), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in counted.toLocalIterator()}
    n = found.pop(-1, 0)
    if not n:
        return None
    df = np.zeros(1 << bits)
    df[list(found)] = list(found.values())
    idf = np.log((1 + n) / (1 + df)) + 1

    share = {k: min(1.0, sample_rows / len(sizes) / v) for k, v in sizes.items()}
    langs = sorted(share)
    draw = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    part = F.element_at(F.create_map(*[F.lit(v) for pair in share.items() for v in pair]), F.col("lang"))

    def features(batches):
        grams = Grams(bits)
        for batch in batches:
            texts, names = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            got = [(k, np.flatnonzero(c), c[np.flatnonzero(c)]) for t, k in zip(texts, names, strict=True) if (c := grams(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in got], pa.string()), pa.array([a.astype("<i4").tobytes() for _, a, _ in got], pa.binary()), pa.array([c.astype("<i4").tobytes() for _, _, c in got], pa.binary())], ["lang", "at", "n"])

    sample = rows.where(draw < part).mapInArrow(thrifty(features), "lang string, at binary, n binary")
    try:
        return fitted(sample, idf, langs, seed)
    finally:
        give_back()  # the driver has much to do yet


def fitted(sample: DataFrame, idf: np.ndarray, langs: list[str], seed: int) -> LangModel:
    """The model whose weights fit the n-grams (lang, at, n) of ``sample``."""
    got = sample.toArrow()
    data = sorted(zip(got["lang"].to_pylist(), got["at"].to_pylist(), got["n"].to_pylist(), strict=True))
    vectors = []
    for name, at, c in data:
        at, c = np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(c, "<i4")
        vectors.append((at, tf_idf(c, idf[at]), langs.index(name)))
    order = np.random.default_rng(seed).permutation(len(vectors))
    held = set(order[: len(order) // 10].tolist())
    weights, bias = ftrl([v for k, v in enumerate(vectors) if k not in held], len(idf), len(langs))
    kept = [vectors[k] for k in sorted(held)]
    warm = best_temperature(np.array([x @ weights[at] + bias for at, x, _ in kept]), np.array([y for _, _, y in kept])) if len(kept) >= 10 else 1.0
    return LangModel(langs, idf, weights, bias, warm)


def predict(docs: DataFrame, model: LangModel | None, text: str = "text") -> DataFrame:
    """Add lang_pred and score (the calibrated probability) to each row.

    Null texts and texts without a letter, and all texts if there is no model, get ``und`` with score 0. Texts are read whole. Of equally likely languages the first
    in alphabetical order is taken; repeated rows stay, each with the same answer; an empty table gives none.
    Columns of ``docs`` named lang_pred or score are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    source = docs.drop("lang_pred", "score")
    names = source.columns

    def run(batches):
        known = shared.value
        grams = Grams(len(known.idf).bit_length() - 1) if known else None
        for batch in batches:
            got = [known.predict(c) if known and (c := grams(t)) is not None else (UNKNOWN, 0.0) for t in batch.column(names.index(text)).to_pylist()]
            cols = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*names, "lang_pred", "score"])

    return source.mapInArrow(thrifty(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields) + ", lang_pred string, score double")


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept out of learning: crc32 of the id as text leaves 1 when divided by 3; a null id counts as its empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1
