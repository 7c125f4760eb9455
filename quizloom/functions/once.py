"""Values that a plan computes once, however often they are used: neither projections nor pushed-down filters repeat them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value)."""
    return F.element_at(F.transform(F.array(value), f), 1)


def with_once(rows: DataFrame, name: str, value: Column, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds a column, for the rows where ``keep`` of it holds."""
    one = F.array(value)
    return rows.select("*", F.explode(F.filter(one, keep) if keep else one).alias(name))
