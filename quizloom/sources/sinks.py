"""One set of rows to several sinks, each of which may fail for some groups: staged, then published whole, with a status row for each sink and group.

A sink turns every row into a line; a group with a row that it cannot turn fails there, and only there. The lines of the other groups are staged beside the sink, their status is
recorded, and one rename publishes them as the run's folder. After a run that broke off, ``recover`` finishes what was staged and recorded, and removes what was not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.operators.summary import sinks_outcome
from quizloom.sources.store import Files, Store
from quizloom.tables import Tables

STATUS = "id string, run string, sink string, grp string, status string, error string, n bigint"
STAGED, SAVED, FAILED = "staged", "saved", "failed"


@dataclass(frozen=True)
class Sink:
    """A folder of text files, and what turns a row into a line of them."""

    name: str
    path: str
    encode: Callable[[dict], str]


class Delivery:
    """Runs of deliveries with the status table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, sinks: list[Sink]):
        self.spark, self.sinks = spark, sinks
        self.status = Store.open(spark, path, STATUS, "id", 16)

    def run(self, run: str, rows: DataFrame, group: str) -> DataFrame:
        """run, sink, grp, status (saved or failed), error, n of each sink and group of the rows. A run that has been delivered before is not delivered again; rows without group are one."""
        for sink in self.sinks:
            if not self._recorded(run, sink).count():
                self._stage(run, rows, group, sink)
        self.recover(run)
        return self.status.read().where(F.col("run") == run).drop("id")

    def outcome(self, run: str) -> DataFrame:
        """grp, success of each group: whether any of the sinks has it."""
        of = self.status.read().where(F.col("run") == run).groupBy("grp")
        saved = of.agg(*[F.bool_or((F.col("sink") == s.name) & (F.col("status") == SAVED)).alias(f"s{k}") for k, s in enumerate(self.sinks)])
        return saved.select("grp", sinks_outcome([(F.lit(True), F.col(f"s{k}")) for k in range(len(self.sinks))]).alias("success"))

    def recover(self, run: str) -> None:
        """Publish what is staged and recorded; remove what is staged only."""
        for sink in self.sinks:
            files = Files(self.spark, sink.path)
            if not self._recorded(run, sink).count():
                files.delete(f".staged-{run}")
                continue
            if f".staged-{run}" in files.names("") and f"run={run}" not in files.names(""):
                files.move(f".staged-{run}", f"run={run}")
            left = self._recorded(run, sink).where(F.col("status") == STAGED)
            self.status.update(left.select("id", F.lit(SAVED).alias("status")), ["status"])

    def _recorded(self, run: str, sink: Sink) -> DataFrame:
        return self.status.read().where((F.col("run") == run) & (F.col("sink") == sink.name))

    def _stage(self, run: str, rows: DataFrame, group: str, sink: Sink) -> None:
        names, encode = rows.columns, sink.encode

        def lines(batches):
            for batch in batches:
                out, errors = [], []
                for row in batch.select(names).to_pylist():
                    try:
                        out.append(encode(row))
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001  whatever a sink raises, its group has failed
                        out.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                yield pa.RecordBatch.from_arrays([batch.column("__grp"), pa.array(out, pa.string()), pa.array(errors, pa.string())], ["grp", "line", "error"])

        grouped = rows.withColumn("__grp", F.coalesce(F.col(group).cast("string"), F.lit("")))
        made = Tables(self.spark, "sinks").save(grouped.mapInArrow(lines, "grp string, line string, error string"), "lines")
        counts = made.groupBy("grp").agg(F.min("error").alias("error"), F.count("*").alias("n"))
        failed = counts.where("error IS NOT NULL").select("grp")
        Files(self.spark, sink.path).delete(f".staged-{run}")  # of a run that broke off before it was recorded
        made.join(failed, "grp", "left_anti").select("grp", F.col("line").alias("value")).write.partitionBy("grp").text(f"{sink.path}/.staged-{run}")
        status = F.when(F.col("error").isNull(), STAGED).otherwise(FAILED)
        key = F.concat_ws("|", F.lit(run), F.lit(sink.name), "grp")
        self.status.insert(counts.select(key.alias("id"), F.lit(run).alias("run"), F.lit(sink.name).alias("sink"), "grp", status.alias("status"), "error", "n"))
