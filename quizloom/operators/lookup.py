"""Scans with optional filters, point lookups, and the joins of skills, tasks, levels and templates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizloom.tables import Tables

WILDCARDS = ("*", "no", "all")


def first_by(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key. One struct is reduced map-side, so a hot key costs no more than any other."""
    rest = [c for c in df.columns if c not in keys]
    ranks = [F.col(o).alias(f"__o{i}") if isinstance(o, str) else o.alias(f"__o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranks, *rest)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.`{c}`").alias(c) for c in rest])


def last_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key, as in assigning to a dictionary in this order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.`{c}`").alias(c) for c in rest])


def lookup_ids(spark: SparkSession, ids: Sequence[int], rows: DataFrame, tasks: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each asked id that exists, in the order asked, repeats kept, with the first task of the id (null without one)."""
    asked = spark.createDataFrame(list(enumerate(ids)), f"pos int, {key} bigint")
    wanted = F.broadcast(asked.select(key).distinct())  # as long as the argument list
    own = rows.join(wanted, key, "left_semi")
    first = first_by(tasks.join(wanted, key, "left_semi"), [key], *order)
    return asked.join(own, key).join(first, key, "left")


def by_task(rows: DataFrame, tasks: DataFrame, key: str, name: Column) -> DataFrame:
    return rows.join(tasks.where(name), key)


def resolve_skills(spark: SparkSession, rows: DataFrame, tasks: DataFrame, ids: Sequence[int] = (), task: str | None = None, key: str = "skill_id") -> DataFrame:
    """Skills by id if there are ids, else by the name of a task, else an error before anything runs."""
    if ids:
        return lookup_ids(spark, ids, rows, tasks, key, "task_name").drop("pos")
    if task:
        return by_task(rows, tasks, key, F.col("task_name") == task)
    raise ValueError("neither skill ids nor a task name")


def skill_params(skills: DataFrame, objectives: Column, n_questions: int, levels: Sequence[str]) -> DataFrame:
    """The parameters of a prompt for each skill; what a prompt does not name is dropped. subject_id holds the skill's id."""
    default = F.lit("")
    return skills.select(
        F.col("skill_id").alias("subject_id"), F.coalesce("subject", default).alias("subject"), F.coalesce("subject_area", default).alias("subject_area"), "skill_id", F.col("skill_name").alias("skill"),
        F.coalesce(objectives, F.array().cast("array<string>")).alias("learning_objectives"), F.lit(n_questions).alias("num_questions"), F.array(*[F.lit(x) for x in levels]).alias("bloom_levels"))


def find(rows: DataFrame, equals: Sequence[tuple[str, object | None]] = (), limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Rows where the first filter with a value holds (all rows if none has one), then a limit in a fixed order."""
    for name, value in equals:
        if value is not None:
            rows = rows.where(F.col(name) == F.lit(value))
            break
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def first_match(rows: DataFrame, condition: Column, order: str) -> DataFrame:
    return rows.where(condition).orderBy(order).limit(1)


def by_object_id(rows: DataFrame, value: str, key: str = "_id") -> DataFrame:
    """The row of a 24-digit hexadecimal id; none if the value is no such id."""
    from quizloom.functions.text import OBJECT_ID

    return rows.where((F.col(key) == F.lit(value)) & F.lit(value).rlike(OBJECT_ID))


def fetch(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows with a key of ``keys``; one semi join instead of batched lookups."""
    return rows.join(keys.select(key), key, "left_semi")


def diagram_candidates(rows: DataFrame, needs: Column, subject: str | None = None, question_type: str | None = None) -> DataFrame:
    """Rows that need a diagram, of a subject and, only with a concrete subject, of a question type."""
    if subject is None or subject in WILDCARDS:
        return rows.where(needs)
    rows = rows.where(needs & (F.col("subject") == subject))
    return rows if question_type is None or question_type in WILDCARDS else rows.where(F.col("question_type") == question_type)


def test_candidates(rows: DataFrame, needs: Column, subject: str | None = None, skill: str | None = None) -> DataFrame:
    """As diagram_candidates for questions of type ``tests``; subject and skill apply independently."""
    rows = rows.where(needs & (F.col("question_type") == "tests"))
    for name, value in (("subject", subject), ("skill", skill)):
        if value is not None and value not in WILDCARDS:
            rows = rows.where(F.col(name) == value)
    return rows


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose output does not exist yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def diagram_action(needs: Column, steps: Column) -> Column:
    """draw: steps to follow; plain: a diagram without steps; none."""
    return F.when(needs & (F.size(steps) > 0), "draw").when(needs, "plain").otherwise("none")


def with_levels(rows: DataFrame, levels: Mapping[str, int]) -> DataFrame:
    """Each row once for each level, level_num beside it. The levels are a literal array, so nothing is joined."""
    pairs = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(v).alias("level_num")) for k, v in levels.items()])
    return rows.withColumn("__level", F.explode(pairs)).select("*", "__level.level", "__level.level_num").drop("__level")


def with_template(rows: DataFrame, templates: DataFrame, key: str = "level") -> DataFrame:
    """Adds the templates of the key; a key without any fails the query."""
    known = templates.withColumn("__known", F.lit(True))
    joined = rows.join(known, key, "left")
    return joined.where(F.when(F.col("__known").isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit("no template for "), F.col(key))).cast("boolean"))).drop("__known")


def batches(rows: DataFrame, size: int, *order: str, ranges: int | None = None) -> DataFrame:
    """Adds batch, from 0, of ``size`` rows each in this order.

    Numbers rows without one task seeing them all: a count for each range of the order, then places within ranges. The
    ranges are written first, as range bounds come from a sample and must not change between the two.
    """
    ranges = ranges or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())
    spread = Tables(rows.sparkSession, "batches").save(spread, "ranges")
    counts = spread.groupBy("__range").count()
    before = counts.withColumn("__before", F.sum("count").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)))  # one row a range
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    placed = spread.withColumn("__n", within).join(F.broadcast(before.select("__range", "__before")), "__range")
    place = F.coalesce("__before", F.lit(0)) + F.col("__n") - 1
    return placed.withColumn("batch", F.floor(place / size)).drop("__range", "__n", "__before")
