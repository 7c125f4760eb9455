"""Token counts without token ids.

Every distinct pre-token of the corpus is split into pieces once. The most frequent ones, a fixed number, go to the
tasks as a dictionary; the frequencies of all others are joined to their counts by a shuffle on the pre-token. The
number of tokens of a document is the sum of both parts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.bpe import piece_counts, vocabulary, word_counts
from quizloom.llm.common import Scratch, small_batches, thrifty

#: Pre-tokens that are broadcast, whatever the size of the corpus, and the characters of one at most: some 15 MB at worst.
HEAD, HEAD_LETTERS = 250_000, 48
#: Pre-tokens a task holds before it passes them on.
HELD = 200_000


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, head: int = HEAD, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keys, n_bytes (of the UTF-8 text), n_tokens, over_limit (n_tokens > limit) for each row of ``docs``.

    A null text counts as empty: no bytes, no tokens, not over the limit. Keys may be null or repeated, as rows are told apart by a number
    of their own. An empty table gives none; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "token-counts")
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def frequencies(batches):
        bpe, held = vocabulary(path), {}
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for w, n in word_counts(bpe, t).items():
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], ["word", "n"])
                    held = {}
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def pieces(batches):
        bpe = vocabulary(path)
        for batch in batches:
            n = piece_counts(bpe, batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["word", "n", "pieces"])

    distinct = texts.mapInArrow(thrifty(frequencies), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    distinct = scratch.save(distinct.mapInArrow(thrifty(pieces), "word string, n long, pieces long"), "pieces")
    # the largest frequencies down to a step of a quarter octave, as many as ``head`` has room for
    step = F.floor(F.log2("n") * 4)
    room, least = head, None
    short = distinct.where(F.length("word") <= HEAD_LETTERS)
    for r in sorted(short.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):
        if (room := room - r["count"]) < 0:
            break
        least = r.step
    top = short.where(step >= least if least is not None else F.lit(False)).select("word", "pieces").toArrow()
    common = spark.sparkContext.broadcast(dict(zip(top["word"].to_pylist(), top["pieces"].to_pylist(), strict=True)))

    def sums(batches):
        """A row for each document with the tokens of its common pre-tokens, and one for each other pre-token in it."""
        from pyspark import TaskContext

        bpe, known = vocabulary(path), common.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, rows, size, count, words = [], [], [], [], []
            for at, t in enumerate(batch.column("__text").to_pylist()):
                row, total = row + 1, 0
                for w, n in word_counts(bpe, t).items():
                    if (k := known.get(w)) is not None:
                        total += n * k
                    else:
                        ids.append(None)
                        rows.append(row)
                        size.append(0)
                        count.append(n)
                        words.append(w)
                ids.append(at)
                rows.append(row)
                size.append(len(t.encode()))
                count.append(total)
                words.append(None)
            at = pa.array(ids, pa.int64())
            cols = [batch.column(k).take(at) for k in keys]
            cols += [pa.array(rows, pa.int64()), pa.array(size, pa.int64()), pa.array(count, pa.int64()), pa.array(words, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [*keys, "__row", "n_bytes", "__n", "__word"])

    source = docs.select(*keys, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    parts = scratch.save(source.mapInArrow(thrifty(sums), f"{kinds}__row long, n_bytes long, __n long, __word string"), "parts")
    rare = parts.where("__word IS NOT NULL").select("__row", "__n", F.col("__word").alias("word"))
    rare = rare.join(distinct.select("word", "pieces"), "word").groupBy("__row").agg(F.sum(F.col("__n") * F.col("pieces")).alias("__rare"))
    n_tokens = F.col("__n") + F.coalesce("__rare", F.lit(0))
    out = parts.where("__word IS NULL").join(rare, "__row", "left")
    return out.select(*keys, "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
