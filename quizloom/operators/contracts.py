"""Checks of the rules that generated questions must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions.text import level_number

DIFFICULTIES = ("Easy", "Medium", "Hard")


def four_options(choices: Column) -> Column:
    return F.coalesce((F.size(choices) == 4) & F.forall(choices, lambda c: c.rlike(r"^[A-D][.)] ")), F.lit(False))


def answer_letter(answer: Column) -> Column:
    return F.coalesce(answer.rlike(r"^[A-D]$"), F.lit(False))


def level_agrees(level: Column, number: Column, least: int = 1) -> Column:
    return F.coalesce((level_number(level) == number) & (number >= least), F.lit(False))


def skill_prefixed(skill: Column, level: Column) -> Column:
    return F.coalesce(skill.startswith(F.concat(level, F.lit("-"))), F.lit(False))


def steps_iff_diagram(steps: Column, needs: Column) -> Column:
    return F.coalesce((F.size(steps) > 0) == needs, F.lit(False))


def verified(hints: Column, old: Column, new: Column, flag: Column) -> Column:
    """Three hints, and a verification flag that tells whether the answer stayed."""
    return F.coalesce((F.size(hints) == 3) & ((old == new) == flag), F.lit(False))


def plain_stem(stem: Column) -> Column:
    return ~F.coalesce(stem.rlike(r"(?i)step 1"), F.lit(False))


def difficulty_known(value: Column) -> Column:
    return F.coalesce(value.isin(*DIFFICULTIES), F.lit(False))


def answer_spread(questions: DataFrame, answer: str) -> DataFrame:
    """answer, n, share of all."""
    counted = questions.groupBy(answer).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("__all"))
    return counted.join(F.broadcast(total)).select(answer, "n", (F.col("n") / F.col("__all")).alias("share"))  # one row


def diagram_ratio(questions: DataFrame, needs: str, low: float, high: float, *by: str) -> DataFrame:
    ratio = F.count_if(F.col(needs)) / F.count("*")
    return questions.groupBy(*by).agg(ratio.alias("ratio"), ratio.between(low, high).alias("ok"))


def count_matches(questions: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """by, want, n, ok: whether each unit has exactly as many questions as asked for."""
    counted = questions.groupBy(by).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return wanted.join(counted, by, "left").select(by, "want", n.alias("n"), (n == F.col("want")).alias("ok"))


def uncovered(objectives: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """Objectives that no question covers."""
    return objectives.join(questions.select(key), key, "left_anti")
