"""A journal of work that must not be done twice, such as paid calls: requests go through a stream with a checkpoint, batch by batch, into a keyed table.

Requests are files, and each file is a batch of the stream. A batch's responses take effect together, by one new version of the table, with the batch's number. Within a batch each task leaves its
responses in a log as it ends, so a run that fails in the middle has lost the requests that its tasks were at, ``per_batch`` of them or thereabouts; the next run takes what the log has and asks the
rest. A request that has a response is not sent again.

A batch costs some jobs and meets the keys of the whole table, so their number is bounded: the batches of a long run are larger, not more, and have more tasks, which keep what one task has at stake.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.sources.bank import table_or_empty
from quizloom.sources.store import Files, Store
from quizloom.tables import Tables

#: Asks the rows in so many tasks.
Ask = Callable[[DataFrame, int], DataFrame]
#: Batches of a run at most, where the number of tasks is free.
BATCHES = 8
#: With it a task's files are in their place when the task ends, whatever becomes of the job.
COMMIT_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


class Journal:
    """Requests and responses at ``path``: a response row for each ``key``; ``answer`` is null where a request has failed."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "request_id", answer: str = "response", buckets: int = 16):
        self.spark, self.path, self.schema, self.key, self.answer = spark, path.rstrip("/"), schema, key, answer
        self.done = Store.open(spark, f"{self.path}/responses", schema, key, buckets)

    def run(self, requests: DataFrame, ask: Ask, per_batch: int = 1000, tasks: int | None = None) -> DataFrame:
        """The responses of all ``requests`` that have one. What an earlier run has left is asked first, then what has no response yet; failed requests are asked again once a run.

        The columns of ``requests`` are those of the first run; repeated keys are asked once, rows without key not at all. With ``tasks``, no more than these ask at a time, and
        batches have ``per_batch`` requests, however many batches that makes; without, as many as the cluster has cores.
        """
        self._stream(requests, ask, per_batch, tasks)
        new = requests.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]).join(self.done.read().select(self.key), self.key, "left_anti")
        new = Tables(self.spark, "journal").save(new.select(requests.columns), "new")
        n = new.count()
        if n:
            batches = -(-n // per_batch)
            new.repartition(batches if tasks else min(batches, BATCHES)).write.mode("append").parquet(f"{self.path}/requests")
            self._stream(requests, ask, per_batch, tasks)
        return self.done.read().join(requests.select(self.key).distinct(), self.key, "left_semi")

    def _stream(self, like: DataFrame, ask: Ask, per_batch: int, tasks: int | None) -> None:
        if not Files(self.spark, f"{self.path}/requests").names(""):
            return
        cores = self.spark.sparkContext.defaultParallelism

        def answer(batch: DataFrame, number: int) -> None:
            done, log = Store(batch.sparkSession, self.done.path), f"{self.path}/log/{number}"
            left = table_or_empty(batch.sparkSession, log, self.schema)  # by a run that broke off in this batch
            todo = batch.join(done.read().select(self.key).union(left.select(self.key)), self.key, "left_anti").select(like.columns)
            parts = tasks or max(cores, -(-batch.count() * cores // per_batch))
            ask(todo, parts).where(F.col(self.answer).isNotNull()).write.mode("append").options(**COMMIT_BY_TASK).parquet(log)
            done.insert(batch.sparkSession.read.schema(self.schema).parquet(log), batch=("calls", number))
            Files(self.spark, self.path).delete(f"log/{number}")

        # one file a batch; none is too old, however long the last run was ago
        files = self.spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).option("maxFileAge", "36500d").parquet(f"{self.path}/requests")
        files.writeStream.foreachBatch(answer).option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
