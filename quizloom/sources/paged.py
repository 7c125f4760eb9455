"""Paged documents as a Spark data source: page ranges are the partitions, pages are read one by one, and what cannot be read is a row with an error.

The folder is one that the driver and all executors have mounted; for files elsewhere there is ``files.binary_pages``. Small files are packed by their sizes; only a file larger than a task's
share is opened where the ranges are planned, to learn its number of pages, and is then read by several tasks.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quizloom.functions.text import ANSWER_KEY_MARKS
from quizloom.sources.bank import counted

#: Bytes of files that a task reads, about, and pages of a batch that it passes on.
TASK_BYTES, BATCH_PAGES = 64_000_000, 64
SCHEMA = "doc string, page_number int, text string, error string"


#: Rows of one page's tables that are numbered apart from those of the next.
PAGE_ROWS = 1 << 20
TABLES = "doc string, page_number int, row_ord bigint, cells array<string>, error string"


class Document(Protocol):
    """An opened file: how many pages it has, the text of one (from 0), and the rows of each table on it."""

    def __len__(self) -> int: ...

    def page(self, number: int) -> str: ...

    def tables(self, number: int) -> list[list[list[str | None]]]: ...

    def close(self) -> None: ...


class PdfDocument:
    """Pages of a PDF file by an optional package, each freed when it has been read."""

    def __init__(self, path: str):
        import pdfplumber

        self.pdf = pdfplumber.open(path)

    def __len__(self) -> int:
        return len(self.pdf.pages)

    def page(self, number: int) -> str:
        page = self.pdf.pages[number]
        try:
            return page.extract_text() or ""
        finally:
            page.close()

    def tables(self, number: int) -> list[list[list[str | None]]]:
        page = self.pdf.pages[number]
        try:
            return page.extract_tables()
        finally:
            page.close()

    def close(self) -> None:
        self.pdf.close()


@dataclass
class Pages(InputPartition):
    """Files with the pages wanted of each: from, up to before (None: to the end)."""

    ranges: Sequence[tuple[str, int, int | None]]


def plan(files: list[tuple[str, int]], task_bytes: int, count: Callable[[str], int | None]) -> list[Pages]:
    """Ranges for each task; ``count`` gives the pages of a large file, None if it cannot be opened."""
    out, held, size = [], [], 0
    for path, n in sorted(files):
        parts = -(-n // task_bytes)
        pages = count(path) if parts > 1 else None
        if pages:
            step = -(-pages // parts)
            out += [Pages([(path, k, min(k + step, pages))]) for k in range(0, pages, step)]
            continue
        if held and size + n > task_bytes:
            out.append(Pages(held))
            held, size = [], 0
        held.append((path, 0, None))
        size += n
    return [*out, Pages(held)] if held else out


def page_text(document: Document, number: int) -> list[tuple]:
    return [(document.page(number),)]


def key_tables(document: Document, number: int) -> list[tuple]:
    """row_ord, cells of the tables on a page of an answer key, each table without its first row; none on another page."""
    if not any(m in document.page(number) for m in ANSWER_KEY_MARKS):
        return []
    found = [row for table in document.tables(number) for row in table[1:]]
    return [((number + 1) * PAGE_ROWS + k, row) for k, row in enumerate(found)]


def read_range(open_document: Callable[[str], Document], rows: Callable[[Document, int], list[tuple]], width: int, path: str, start: int, stop: int | None) -> Iterator[tuple]:
    """What ``rows`` (of ``width`` values) gives for each page; a page that fails has one row with an error, a file that cannot be opened one without page."""
    try:
        document = open_document(path)
    except Exception as e:  # noqa: BLE001  readers of binary formats raise errors of their own
        yield path, None, *[None] * width, f"{type(e).__name__}: {e}"
        return
    try:
        for k in range(start, len(document) if stop is None else stop):
            try:
                made = [(path, k + 1, *row, None) for row in rows(document, k)]
            except Exception as e:  # noqa: BLE001
                made = [(path, k + 1, *[None] * width, f"{type(e).__name__}: {e}")]
            yield from made
    finally:
        document.close()


def source(open_document: Callable[[str], Document], rows: Callable[[Document, int], list[tuple]] = page_text, ddl: str = SCHEMA, name: str = "paged_files") -> type[DataSource]:
    """A data source of what ``rows`` gives for the pages of files that ``open_document`` opens; options ``path``, ``pattern`` (of file names) and ``task_bytes``."""
    kinds = to_arrow_schema(StructType.fromDDL(ddl))

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.path, self.pattern, self.task_bytes = options["path"], options.get("pattern", "*"), int(options.get("task_bytes", TASK_BYTES))

        def partitions(self):
            def pages(path: str) -> int | None:
                try:
                    document = open_document(path)
                except Exception:  # noqa: BLE001  the task that reads it gives the error
                    return None
                try:
                    return len(document)
                finally:
                    document.close()

            with os.scandir(self.path) as entries:
                files = [(e.path, e.stat().st_size) for e in entries if e.is_file() and fnmatch(e.name, self.pattern) and e.name[0] not in "._"]
            return plan(files, self.task_bytes, pages) or [Pages([])]

        def read(self, partition):
            held = []
            for path, start, stop in partition.ranges:
                for row in read_range(open_document, rows, len(kinds) - 3, path, start, stop):
                    held.append(row)
                    if len(held) == BATCH_PAGES:
                        yield batch(held)
                        held = []
            yield batch(held)

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in enumerate(kinds)], kinds.names)

    class PagedFiles(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ddl

        def reader(self, schema):
            return Reader(self.options)

    return PagedFiles


def pages(spark: SparkSession, path: str, open_document: Callable[[str], Document] = PdfDocument, pattern: str = "*", task_bytes: int = TASK_BYTES) -> DataFrame:
    """doc (the path), page_number (from 1), text, error of each page of the files in a folder, in one pass; an empty folder gives no rows."""
    return load(spark, source(open_document), path, pattern, task_bytes)


def answer_tables(spark: SparkSession, path: str, open_document: Callable[[str], Document] = PdfDocument, pattern: str = "*", task_bytes: int = TASK_BYTES) -> DataFrame:
    """doc, page_number, row_ord, cells, error of the table rows on answer-key pages of the files in a folder; row_ord is in the order of pages and rows."""
    return load(spark, source(open_document, key_tables, TABLES, "paged_tables"), path, pattern, task_bytes)


def load(spark: SparkSession, kind: type[DataSource], path: str, pattern: str, task_bytes: int) -> DataFrame:
    spark.dataSource.register(kind)
    return spark.read.format(kind.name()).option("path", path).option("pattern", pattern).option("task_bytes", task_bytes).load()


def write_outcomes(rows: DataFrame, reason: Column, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good rows, rejected rows with their reason, counts n and rejected): the rows are computed, counted and written once, parted by whether ``reason`` is null."""
    told = rows.withColumn("reason", reason).withColumn("outcome", F.when(F.col("reason").isNull(), "good").otherwise("rejected"))
    counts = counted(told, lambda out: out.write.mode("append").partitionBy("outcome").parquet(path), rejected=F.col("reason").isNotNull())
    back = rows.sparkSession.read.schema(told.schema).parquet(path)
    return back.where("outcome = 'good'").select(rows.columns), back.where("outcome = 'rejected'").drop("outcome"), counts
