"""Configuration files and the environment, as rows and as plain values."""

from __future__ import annotations

import configparser
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions.text import subject_of_task

KV_SCHEMA = "ord int, section string, key string, value string"


def properties(spark: SparkSession, text: str) -> DataFrame:
    """ord, section, key, value of an INI text with ``${section:key}`` references; all values are strings."""
    parser = configparser.ConfigParser(interpolation=configparser.ExtendedInterpolation())
    parser.read_string(text)
    rows = [(s, k, v) for s in parser.sections() for k, v in parser.items(s)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], KV_SCHEMA)


def environment(defaults: dict[str, str | None]) -> dict[str, str | None]:
    """Values of environment variables, read on the driver only."""
    return {k: os.environ.get(k, v) for k, v in defaults.items()}


def task_config(spark: SparkSession, path: str) -> DataFrame:
    """The sections of a JSON task file with the subject, the second word of the task's name; a missing section fails the query."""
    raw = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    parts = {n: F.try_variant_get("v", f"$.{n}", "variant") for n in ("database", "prompts", "pdf", "task")}
    checked = raw.select(*[F.when(p.isNotNull(), p).otherwise(F.raise_error(F.lit(f"the configuration lacks {n}")).cast("variant")).alias(n) for n, p in parts.items()])
    return checked.withColumn("subject", subject_of_task(F.try_variant_get("task", "$.name", "string")))
