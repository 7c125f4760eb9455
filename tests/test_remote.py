"""Relational tables read in parts, and vectors made in batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quizloom.sources import bank, providers

URL, DRIVER = "jdbc:derby:memory:skills;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture(scope="module")
def skills(spark):
    rows = spark.range(1, 5001).selectExpr("CAST(id * 3 AS INT) AS SKILL_ID", "concat('skill ', id) AS SKILL_NAME")
    rows.write.format("jdbc").options(url=URL, driver=DRIVER, dbtable="SKILLS", createTableColumnTypes="SKILL_NAME VARCHAR(60)").mode("overwrite").save()
    return "SKILLS"


def test_parts(spark, skills):
    df = bank.jdbc(spark, URL, skills, column="SKILL_ID", parts=6, driver=DRIVER)
    assert df.rdd.getNumPartitions() == 6 and df.count() == 5000 and df.agg(F.sum("SKILL_ID")).first()[0] == 3 * 5000 * 5001 // 2
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 900
    plan = df.where("SKILL_NAME = 'skill 7'").select("SKILL_ID")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(SKILL_NAME,skill 7)" in plan and "ReadSchema: struct<SKILL_ID:int>" in plan
    assert bank.jdbc(spark, URL, skills, driver=DRIVER).rdd.getNumPartitions() == 1


def test_asked_ids(spark, skills):
    ids = [*range(0, 9000, 2), 6, 6, -1]
    df = bank.jdbc(spark, URL, skills, column="SKILL_ID", ids=ids, driver=DRIVER)
    assert {r.SKILL_ID for r in df.collect()} == {i for i in ids if i > 0 and i % 3 == 0} and df.rdd.getNumPartitions() == 5
    assert bank.jdbc(spark, URL, skills, column="SKILL_ID", ids=[], driver=DRIVER).collect() == []
    named = bank.jdbc(spark, URL, skills, column="SKILL_NAME", ids=["skill 1", "x' OR '1' = '1"], driver=DRIVER)
    assert [r.SKILL_ID for r in named.collect()] == [3]


def test_credentials(spark, skills, monkeypatch):
    monkeypatch.setenv("SKILLS_USER", "SA")
    monkeypatch.setenv("SKILLS_PASSWORD", "x")
    with pytest.raises(KeyError, match="NOT_SET"):
        bank.jdbc(spark, URL, skills, "SKILLS_USER", "NOT_SET", driver=DRIVER)
    own = bank.jdbc(spark, "jdbc:derby:memory:own;create=true", "SYSIBM.SYSDUMMY1", "SKILLS_USER", "SKILLS_PASSWORD", driver=DRIVER)
    assert own.count() == 1


def test_vectors_in_batches(spark):
    calls, texts = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def vectors(some):
        calls.add(1)
        texts.add(len(some))
        if any(t.startswith("bad") for t in some):
            raise ValueError("bad")
        return [[float(len(t))] for t in some]

    rows = spark.range(1000, numPartitions=1).selectExpr("id", "CASE WHEN id = 500 THEN NULL WHEN id = 7 THEN 'bad' ELSE repeat('x', CAST(id AS INT) % 50) END AS t")
    got = {r.id: r.embedding for r in providers.embed(rows, "id", "t", vectors=vectors, batch_rows=100).collect()}
    assert got == {i: None if i in (7, 500) else [float(i % 50)] for i in range(1000)}
    assert 10 <= calls.value <= 10 + 100 and texts.value == 999 + 99  # the list with the failing text is asked one by one
    made = providers.embed(rows.limit(9), "id", "t", connect=lambda: vectors, batched=True).collect()
    assert len(made) == 9
    one = providers.embed(rows.limit(9), "id", "t", connect=lambda: lambda t: [1.0]).collect()
    assert [r.embedding for r in one] == [[1.0]] * 9


def test_lists_by_length():
    lists = providers.by_length(["a" * n for n in (5, 90, 1, 40, 300)] + [None], 3, 100)
    assert lists == [[4], [1], [3, 0], [2]] or lists == [[4], [1], [3, 0, 2]]
    assert providers.by_length([], 3, 100) == []
