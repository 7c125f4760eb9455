"""Step chains, their summaries, and configuration as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.operators.lookup import last_by


def chain(rows: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Adds success and error: the name of the first step whose condition is not true; later steps do not count."""
    failed = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in steps])
    return rows.withColumn("error", failed).withColumn("success", failed.isNull())


def summarise(log: DataFrame, *by: str, success: str = "success") -> DataFrame:
    """total_processed, successful, failed, success_rate ('66.7%') and success (any) for each group."""
    ok = F.count_if(F.col(success))
    n = F.count("*")
    return log.groupBy(*by).agg(n.alias("total_processed"), ok.alias("successful"), (n - ok).alias("failed"), F.format_string("%.1f%%", ok / n * 100).alias("success_rate"), (ok > 0).alias("success"))


def sinks_outcome(requested: list[tuple[Column, Column]]) -> Column:
    """True unless all requested sinks failed; false if none was requested. Pairs of (requested, saved)."""
    out = F.lit(False)
    for asked, saved in requested:
        out = out | (asked & F.coalesce(saved, F.lit(False)))
    return out


def flatten_config(kv: DataFrame) -> DataFrame:
    """key, value over all sections; the later entry of a key wins."""
    return last_by(kv.select("ord", "key", "value"), ["key"], "ord").select("key", "value")


def with_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))
