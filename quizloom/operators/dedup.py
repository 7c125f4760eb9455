"""De-duplication within a batch, across runs, and the filling of deficits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizloom.operators.lookup import first_by

SALTS = 32


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in this order; rows with a null key go."""
    return first_by(rows.where(F.col(key).isNotNull()), [key], *order)


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier run has."""
    return rows.join(seen.select(key), key, "left_anti")


def seen_after(seen: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The state that the next run starts from."""
    return seen.select(key).union(rows.select(key)).where(F.col(key).isNotNull()).distinct()


def trim(rows: DataFrame, group: Sequence[str], want: str, *order: str) -> DataFrame:
    """At most ``want`` rows of each group, the first in this order.

    A hot group is cut down in salted parts first, so that no task sorts more of it than ``SALTS`` times what is wanted.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    for keys in ([*group, "__salt"], [*group]):
        n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = salted.withColumn("__n", n).where(F.col("__n") <= F.col(want)).drop("__n")
    return salted.drop("__salt")


def deficits(wanted: DataFrame, have: DataFrame, unit: str) -> DataFrame:
    """unit, want, have, deficit (never below 0) for each unit."""
    counted = have.groupBy(unit).agg(F.count("*").alias("have"))
    n = F.coalesce("have", F.lit(0))
    return wanted.join(counted, unit, "left").select(unit, "want", n.alias("have"), F.greatest(F.lit(0), F.col("want") - n).alias("deficit"))


def fill(wanted: DataFrame, produce: Callable[[DataFrame, int], DataFrame], unit: str, key: str, pos: str, save: Callable[[DataFrame, str], DataFrame], retries: int = 3, compat: bool = False) -> DataFrame:
    """Rows for each unit up to its want: the first answers, then up to ``retries`` more attempts at what lacks.

    ``produce(units with deficit, attempt)`` returns unit, key and pos for each answer; ``save`` writes a table, as a call must not be
    repeated by a recomputed plan. Of equal keys the first by attempt, unit and pos stays. With ``compat`` attempts do not see
    each other's keys, and what the first one gives in excess is kept.
    """
    got, short = None, wanted.select(unit, "want", F.lit(0).cast("bigint").alias("have"), F.col("want").alias("deficit"))
    for attempt in range(retries + 1):
        fresh = produce(short.where("deficit > 0"), attempt).withColumn("attempt", F.lit(attempt))
        fresh = save(first_seen(fresh, key, unit, pos), f"attempt-{attempt}")
        fresh = fresh if got is None or compat else unseen(fresh, got, key)
        got = fresh if got is None else got.unionByName(fresh)
        short = deficits(wanted, got, unit)
        if not short.where("deficit > 0").limit(1).count():
            break
    if compat and attempt == 0:
        return got
    return trim(got.join(wanted.select(unit, "want"), unit), [unit], "want", "attempt", pos).drop("want")
