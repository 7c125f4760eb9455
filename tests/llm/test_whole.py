"""Cases that earlier forms of the operators answered in part only."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quizloom.llm import fingerprint, quality, substring_dedup
from tests.llm.brute import likeness, pieces


def test_fingerprints_without_punctuation(spark):
    """Texts of one paragraph are likelier their own edit than the next text, with the values of a plain count of pieces."""
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    texts = ["buffalo " * 2320, words("alpha", 263), "x" * 3000, "".join(chr(0x4E00 + i * 7 % 5000) for i in range(300)), words("beta", 40), "Same line.\n" * 50, words("gamma", 3000), "same " * 30]
    docs = spark.createDataFrame(list(enumerate([*texts, "One. Two! Three?\nFour."])), "doc_id long, text string")

    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    every = [r[1] for r in docs.collect()]
    for i, t in enumerate(every):
        after, k = every[i - 1], len(t) // 3
        assert got[i].near_edited == likeness(pieces(t), pieces(t[: len(t) - k] + after[:k])) and got[i].near_next == likeness(pieces(t), pieces(after))
        if i < len(texts):
            assert got[i].near_edited > got[i].near_next and (len(t) < 300 or got[i].near_edited > 0.2)


@pytest.mark.parametrize("k", [40, 9_950, 9_960, 10_000])
def test_top_k_below_a_value_of_nearly_all_rows(spark, monkeypatch, k):
    """A boundary range whose quantiles all are its top value, which the k-th is or is below."""
    monkeypatch.setattr(quality, "SORTED", 20)
    score = lambda i: i / 10_000 if i % 200 == 0 else 1.5
    rows = spark.range(10_000).select(F.col("id").alias("__row"), F.when(F.col("id") % 200 == 0, F.col("id") / 10_000).otherwise(1.5).alias("s"))
    got = {r["__row"] for r in quality.flag_top_k(rows, k, "s", "__row").where("kept").collect()}
    assert got == set(sorted(range(10_000), key=lambda i: (-score(i), i))[:k])


def test_lazy_results_of_substring_dedup(spark, monkeypatch):
    """Two results read late, over an input that comes in another order each time it is computed."""
    monkeypatch.setattr(substring_dedup, "PACK_BYTES", 2_000)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"start {i} " + " ".join(f"w{i}x{k}" for k in range(i % 17)) + f" {passage} {i} end") for i in range(300)], "doc_id long, text string")
    results = [substring_dedup.drop_repeats(docs.repartition(5).orderBy(F.rand()), rewrite=False) for _ in range(2)]
    for found in results:
        assert {r.doc_id: r.n_removed for r in found.collect()} == {i: 40 * (i > 0) for i in range(300)}


def test_second_session(tmp_path):
    """Every operator that writes tables works in a second session of the process."""
    program = """
from pyspark.sql import SparkSession
from quizloom.llm import hard_negatives, minhash, substring_dedup
for _ in range(2):
    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", FOLDER).getOrCreate()
    docs = spark.createDataFrame([(i, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 2) for i in range(9)], "doc_id long, text string")
    found = substring_dedup.drop_repeats(docs, rewrite=False)
    assert sum(r.n_removed for r in found.collect()) == 8 * 28
    assert sum(r.kept for r in minhash.near_duplicates(docs).collect()) == 1
    vectors = spark.createDataFrame([(i, [1.0, i / 100], i % 2) for i in range(20)], "vec_id long, embedding array<double>, label int")
    hard_negatives.mine(vectors, lambda i: i % 10 == 0).collect()
    spark.stop()
"""
    root = Path(__file__).parents[2]
    env = os.environ | {"PYTHONPATH": f"{root}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"}
    subprocess.run([sys.executable, "-c", program.replace("FOLDER", repr(str(tmp_path)))], check=True, env=env, timeout=300)
