"""Written tables between the steps of a job, in the shared folder the session names."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FOLDER = "/tmp/checkpoints"


class Tables:
    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        self.spark, self.path = spark, f"{(root or DEFAULT_FOLDER).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, tag: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{tag}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(folder)  # when the session ends
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{tag}")
