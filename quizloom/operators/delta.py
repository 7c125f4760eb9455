"""Differences between two copies of a bank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def classify(source: DataFrame, target: DataFrame, key: str, content: str, order: str | None = None) -> DataFrame:
    """key, status (added, deleted, changed, same): one pass over a full outer join.

    Rows without key are on neither side. Of repeated keys the last one by ``order`` is compared, as the last read one; without an order, or among
    equals, the one with the greatest content.
    """
    def side(rows: DataFrame, name: str) -> DataFrame:
        last = F.max(content) if order is None else F.max(F.struct(order, content))[content]
        return rows.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias(name))

    both = side(source, "__s").join(side(target, "__t"), key, "full_outer")
    status = F.when(F.col("__t").isNull(), "added").when(F.col("__s").isNull(), "deleted").when(F.col("__s") != F.col("__t"), "changed").otherwise("same")
    return both.select(key, status.alias("status"))


def field_changes(source: DataFrame, target: DataFrame, key: str, doc: str) -> DataFrame:
    """key, field, status of every top-level field that differs between the objects (VARIANT) of a key on both sides.

    added: the target has no such field; removed: the source has none; to_null and from_null: the source's, the target's is an explicit null; else changed. Values are compared as canonical
    JSON. Rows without key, and documents that are no objects, have no fields. The rows of a key meet once, in one of a fixed number of parts: sides are neither broadcast nor joined.
    """
    def fields(rows: DataFrame, source: bool) -> DataFrame:
        parts = rows.where(F.col(key).isNotNull()).lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col(doc).outer()).alias("f"))
        value, none = F.to_json("f.value"), F.lit(None).cast("string")
        return parts.select(key, F.col("f.key").alias("field"), (value if source else none).alias("s"), (none if source else value).alias("t"), F.lit(source).alias("__source"))

    # a number given, as adaptive execution would join parts that are small only while packed
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = fields(source, True).unionByName(fields(target, False)).repartition(parts, key)
    one = every.groupBy(key, "field").agg(F.max("s").alias("s"), F.max("t").alias("t"), F.max("__source").alias("__in_s"), F.min("__source").alias("__all_s"))
    own = Window.partitionBy(key)
    both = one.withColumns({"__in_s": F.max("__in_s").over(own), "__all_s": F.min("__all_s").over(own)}).where(F.col("__in_s") & ~F.col("__all_s") & F.col("field").isNotNull())
    null = F.lit("null")
    status = F.when(F.col("t").isNull(), "added").when(F.col("s").isNull(), "removed").when(F.col("s") == null, "to_null").when(F.col("t") == null, "from_null").otherwise("changed")
    return both.where(~F.col("s").eqNullSafe(F.col("t"))).select(key, "field", status.alias("status"))


def stats(classes: DataFrame) -> DataFrame:
    return classes.agg(*[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("added", "deleted", "changed")])


def apply_added(source: DataFrame, target: DataFrame, key: str, dry_run: bool = False) -> DataFrame:
    """The target with every source row whose key it lacks; deleted and changed rows are left as they are."""
    if dry_run:
        return target
    return target.unionByName(source.where(F.col(key).isNotNull()).join(target.select(key), key, "left_anti").select(target.columns))


def merge_changes(rows: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The rows with the fields of their change, where there is one."""
    new = changes.select(F.col(key).alias("__key"), *[F.col(f).alias(f"__{f}") for f in fields])
    out = rows.join(new, F.col(key) == F.col("__key"), "left")
    return out.select(*[F.when(F.col("__key").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns])
