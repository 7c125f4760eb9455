"""Keys that earlier runs have had: a table in buckets, and a Bloom filter beside it that spares most look-ups.

The filter is a table of 64-bit words. A key has one word of it, by a hash, and ``MASK_BITS`` bits there, by another; it may be in the state only if all of them are set. A batch is joined
with its words, and those of its keys that pass meet the buckets of the state that they lie in, so the answer is exact and the rest of the state is not read.
New keys are added to their buckets and words only. The filter is written before the state: what a failed run leaves in it costs a look-up, no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.sources.store import Store
from quizloom.tables import Tables

#: Bits of a key's word, and keys a word is meant for: 16 bits a key.
MASK_BITS, KEYS_A_WORD = 4, 4
WORDS = "words"


class SeenState:
    """The state at ``path``. ``expected`` keys size its filter at first; when there are more it is made anew, four times as large."""

    def __init__(self, spark: SparkSession, path: str, key: str = "hash", kind: str = "string", buckets: int = 64, expected: int = 1 << 20):
        self.spark, self.key, self.kind = spark, key, kind
        self.keys = Store.open(spark, f"{path}/keys", f"`{key}` {kind}", key, buckets)
        self.filter = Store.open(spark, f"{path}/filter", "word bigint, bits bigint", "word", buckets, {WORDS: self._words_for(expected)})

    def read(self, version: int | None = None) -> DataFrame:
        return self.keys.read(version)

    def in_order(self, version: int | None = None) -> DataFrame:
        """The state with the place of each key in key order, from 0, numbered in parts of the range."""
        from quizloom.operators.lookup import batches

        return batches(self.read(version), 1, self.key).withColumnRenamed("batch", "place")

    def possible(self, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` that pass the filter."""
        words = self.filter.manifest().properties[WORDS]
        own = rows.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast(self.kind).alias(self.key)).distinct().withColumn("word", self._word(words)).withColumn("mask", self._mask())
        return own.join(self.filter.read(), "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(self.key)

    def known(self, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` that the state has."""
        m = self.keys.manifest()
        if not m.rows:
            return self.keys.read()
        hits = Tables(self.spark, "seen").save(self.possible(rows).withColumn("bucket", self.keys.bucket(m)), "hits")
        asked = frozenset(r[0] for r in hits.select("bucket").distinct().collect())  # as many as there are buckets, at most
        return hits.select(self.key).join(self.keys.rows_in(asked, m), self.key, "left_semi")

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the state lacks; rows without key are among them."""
        return rows.join(self.known(rows), self.key, "left_anti").select(rows.columns)

    def add(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Adds the keys of the rows; how many were new. Nothing new leaves the state, and its version, as they are."""
        fresh = Tables(self.spark, "seen").save(self.unseen(rows.select(F.col(self.key).cast(self.kind).alias(self.key))).where(F.col(self.key).isNotNull()).distinct(), "fresh")
        before = self.keys.manifest().rows
        self.filter.combine(self._bits(fresh, self.filter.manifest().properties[WORDS]), {"bits": F.bit_or})
        after = self.keys.insert(fresh, batch=batch, single=True).rows
        if after > self.filter.manifest().properties[WORDS] * KEYS_A_WORD:
            self._make_filter(4 * after)
        return after - before

    @staticmethod
    def _words_for(keys: int) -> int:
        return 1 << max(6, (keys // KEYS_A_WORD - 1).bit_length())

    def _make_filter(self, room: int) -> None:
        words = self._words_for(room)
        self.filter.replace(self._bits(self.keys.read(), words), {WORDS: words})

    def _bits(self, keys: DataFrame, words: int) -> DataFrame:
        return keys.select(self._word(words).alias("word"), self._mask().alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))

    def _word(self, words: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), self.key), F.lit(words).cast("bigint"))

    def _mask(self) -> Column:
        """A key's bits, by six bits of a hash each."""
        h = F.xxhash64(F.lit(2), self.key)
        out = F.lit(0).cast("bigint")
        for k in range(MASK_BITS):
            place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
            out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
        return out
