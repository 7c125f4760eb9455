"""Scratch tables, batch sizes, workers' memory and the word pattern the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import math
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word-based contracts: space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
DEFAULT_SCRATCH = "/tmp/checkpoints"


#: What an Arrow batch holds at most, but for a single longer row: rows and bytes.
BATCH_ROWS, BATCH_BYTES = 1024, "2m"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers, so that neither long texts nor packs add up there.

    All operators set the same bounds, as lazy results read the session's settings when they run.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def give_back() -> None:
    """Return what this Python worker no longer uses to the system: it stays for tasks to come, beside others on its machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def thrifty(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of ``mapInArrow``, giving memory back at the end of a task."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def on_a_grid(blocks: DataFrame, chunks: DataFrame, n_blocks: int, n_chunks: int, ratio: float, on: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``blocks`` (numbered in ``block``) beside every one of ``chunks`` (in ``chunk``) with equal ``on`` columns, as joined rows.

    They meet in the cells of a grid with about eight cells a core: a block is sent once for each column, a chunk once for each row of the grid, so what is sent does not grow with the square of
    the table. ``ratio`` is how much larger all blocks are than all chunks.
    """
    spark = blocks.sparkSession
    tasks = min(n_blocks * n_chunks, 8 * max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism))
    rows = min(n_blocks, tasks, max(math.isqrt(int(tasks * max(1, ratio))), -(-tasks // n_chunks)))
    columns = min(n_chunks, -(-tasks // rows))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = blocks.withColumn("__r", F.pmod("block", F.lit(rows))).withColumn("__c", each(columns))
    right = chunks.withColumn("__c", F.pmod("chunk", F.lit(columns))).withColumn("__r", each(rows))
    # an explicit number of partitions, as adaptive execution would put the few rows into one task
    left, right = (side.repartition(tasks, "__r", "__c", *on) for side in (left, right))
    return left.join(right, ["__r", "__c", *on])


class Scratch:
    """Tables written to the folder that all executors share, to cut lineage.

    A lost executor costs the tasks it ran since the last table, not the whole job. The folder is the session's
    ``spark.checkpoint.dir``; where it is unset, a fixed local one if all runs in one process, as in tests, else an error. What is left
    there goes when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = root or DEFAULT_SCRATCH
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, tag: str) -> DataFrame:
        path = f"{self.path}/{tag}"
        df.write.option("compression", "zstd").parquet(path)
        folder, system = self._at(self.path)
        system.deleteOnExit(folder)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_dealt(self, df: DataFrame, tag: str, key: str, n: int) -> DataFrame:
        """The rows dealt to n buckets by a key, so that later joins on it leave them where they are."""
        name = f"{tag}_{uuid.uuid4().hex}"
        writer = df.repartition(n, key).write.format("parquet").option("compression", "zstd")
        writer.bucketBy(n, key).option("path", f"{self.path}/{tag}").saveAsTable(name)
        folder, system = self._at(self.path)
        system.deleteOnExit(folder)
        out = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name only: the files are outside the warehouse, and the frame knows them
        return out

    def drop(self, *tags: str) -> None:
        """Delete tables that nothing lazy still reads."""
        for tag in tags:
            path, system = self._at(f"{self.path}/{tag}")
            system.delete(path, True)

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())
