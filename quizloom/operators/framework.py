"""Course frameworks: subject, units, topics, objectives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions.jsonfix import objective_text


def unit_objectives(frameworks: DataFrame, subject: str, unit: str) -> DataFrame:
    """framework_ord, topic_pos, objective_pos, objective: a row for each objective text of a unit, over all frameworks of the subject.

    ``frameworks``: ord, subject, units array<struct<unit, topics array<struct<topic, objectives array<variant>>>>>. Units are filtered in the array, before any explode.
    """
    own = frameworks.where(F.col("subject") == subject).withColumn("units", F.filter("units", lambda u: u["unit"] == unit))
    asked = frameworks.sparkSession.range(1).select(F.lit(subject).alias("s"), F.lit(unit).alias("n"))
    return objectives_for(asked, own, "s", "n").drop("s", "n").where("objective IS NOT NULL")


def objectives_for(skills: DataFrame, frameworks: DataFrame, subject: str = "subject", unit: str = "unit") -> DataFrame:
    """The rows of ``skills`` with topic_pos, objective_pos and objective, one for each objective of their unit in order of framework, unit and topic; a skill without any keeps one row with nulls.

    One join for all skills; positions of topics count over all units of the name.
    """
    units = frameworks.select(F.col("subject").alias("__subject"), "ord", F.posexplode("units").alias("u", "x")).select("__subject", F.col("x.unit").alias("__unit"), "ord", "u", F.posexplode("x.topics").alias("t", "topic"))
    found = units.select("__subject", "__unit", "ord", "u", F.col("t").alias("topic_pos"), F.posexplode("topic.objectives").alias("objective_pos", "o"))
    found = found.withColumn("objective", objective_text(F.col("o"))).where("objective IS NOT NULL")
    out = skills.join(found, (F.col(subject) == F.col("__subject")) & (F.col(unit) == F.col("__unit")), "left")
    return out.select(*skills.columns, F.col("ord").alias("framework_ord"), "topic_pos", "objective_pos", "objective")


def flat_objectives(topics: Column) -> Column:
    """All objective texts of a unit's topics in order, as an array expression."""
    texts = F.flatten(F.transform(topics, lambda t: F.transform(F.coalesce(t["objectives"], F.array().cast("array<variant>")), objective_text)))
    return F.coalesce(F.filter(texts, lambda o: o.isNotNull()), F.array().cast("array<string>"))


def find_unit(units: Column, name: str) -> Column:
    """Units of this name in any case; a missing name is the empty one."""
    return F.filter(units, lambda u: F.lower(F.coalesce(u["unit"], F.lit(""))) == name.lower())


def allocate(units: DataFrame, total_questions: int, weight: str = "weight") -> DataFrame:
    """Adds n_questions = ceil(weight * total / 100) to units of positive weight; none if all weights add up to 0."""
    w = F.coalesce(F.col(weight), F.lit(0))
    total = units.agg(F.sum(w).alias("__total"))
    out = units.join(F.broadcast(total)).where((F.col("__total") != 0) & (w > 0))  # one row
    return out.withColumn("n_questions", F.ceil(w * F.lit(total_questions) / F.lit(100)).cast("bigint")).drop("__total")


def collection_stats(rows: DataFrame, subject: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct(subject).alias("n_subjects"), F.min(subject).alias("first_subject"))


def sample_path(frameworks: DataFrame) -> DataFrame:
    """The first unit, topic and objective of the first framework; nulls where a level is empty."""
    unit = F.get("units", F.lit(0))
    topic = F.get(unit["topics"], F.lit(0))
    first = frameworks.orderBy("ord").limit(1)
    return first.select("subject", unit["unit"].alias("unit"), topic["topic"].alias("topic"), objective_text(F.get(topic["objectives"], F.lit(0))).alias("objective"))
