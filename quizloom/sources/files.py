"""Files as rows: prompt templates, sample questions, PDF pages, images. Parsers of binary formats are optional packages."""

from __future__ import annotations

import io
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quizloom.functions import jsonfix
from quizloom.functions.text import ANSWER_KEY_MARKS, file_kind


def templates(spark: SparkSession, path: str, strip: bool = True) -> DataFrame:
    """template_id (file name), body."""
    body = F.trim("value") if strip else F.col("value")
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("template_id"), body.alias("body"))


def sample_questions(spark: SparkSession, path: str) -> DataFrame:
    """question texts of a JSON list, in order; none if the root is no list."""
    v = F.try_parse_json("value")
    listed = F.when(jsonfix.is_list(v), F.try_variant_get(v, "$", "array<variant>"))
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(listed).alias("pos", "q"))
    return rows.select("pos", F.coalesce(F.try_variant_get("q", "$.question", "string"), F.try_variant_get("q", "$", "string")).alias("question"))


def output_ids(spark: SparkSession, path: str, prefix: str = "diagram_") -> DataFrame:
    """id of each existing output file, from its name alone."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*.png").load(path).select("path")
    return names.select(F.regexp_extract("path", rf"{prefix}([^/]*)\.png$", 1).alias("id"))


#: Bytes of file contents that a Python worker gets at a time, but for a single longer file: the bound that all of the library sets.
BATCH_BYTES = "2m"


def contents(spark: SparkSession, path: str) -> DataFrame:
    """doc (the path), content of each file."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("doc"), "content")


def binary_pages(spark: SparkSession, path: str, reader: Callable[[bytes], list[str]] | None = None, broken: bool | None = False) -> DataFrame:
    """doc, page_number (from 1), text of each page of the PDF files at ``path``; with ``broken`` doc and error of the files that cannot be read."""
    return read_files(contents(spark, path), lambda content: [(i + 1, t) for i, t in enumerate((reader or pdf_pages)(content))], "page_number int, text string", broken)


def binary_tables(spark: SparkSession, path: str, reader: Callable[[bytes], list[tuple[str, list[list[str | None]]]]] | None = None, broken: bool | None = False) -> DataFrame:
    """doc, row_ord, cells of the tables on answer-key pages of the PDF files at ``path``, each table without its first row; with ``broken`` doc and error of the others.

    ``reader`` gives the text and the table rows of each page.
    """

    def rows(content: bytes) -> list[tuple]:
        found = [r for text, table in (reader or pdf_tables)(content) if any(m in (text or "") for m in ANSWER_KEY_MARKS) for r in table[1:]]
        return list(enumerate(found))

    return read_files(contents(spark, path), rows, "row_ord int, cells array<string>", broken)


def read_files(files: DataFrame, rows: Callable[[bytes], list[tuple]], schema: str, broken: bool | None) -> DataFrame:
    """doc and what ``rows`` gives for each file; with ``broken`` doc and error of the files for which it fails instead, and if that is None all rows of both kinds, with the error, in one pass.

    One file that fails leaves the others alone.
    """
    kinds = to_arrow_schema(StructType.fromDDL(f"doc string, {schema}, error string"))

    def run(batches):
        for batch in batches:
            out = []
            for doc, content in zip(batch.column("doc").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    out += [(doc, *r, None) for r in rows(content)]
                except Exception as e:  # noqa: BLE001  readers of binary formats raise errors of their own
                    out.append((doc, *[None] * (len(kinds) - 2), f"{type(e).__name__}: {e}"))
            cols = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds, strict=True)], kinds.names)

    found = files.mapInArrow(run, f"doc string, {schema}, error string")
    if broken is None:
        return found
    return found.where("error IS NOT NULL").select("doc", "error") if broken else found.where("error IS NULL").drop("error")


def pdf_tables(content: bytes) -> list[tuple[str, list[list[str | None]]]]:
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return [(p.extract_text() or "", rows) for p in pdf.pages for rows in p.extract_tables()]


def pdf_pages(content: bytes) -> list[str]:
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return [p.extract_text() or "" for p in pdf.pages]


def image_text(content: bytes) -> str:
    import pytesseract
    from PIL import Image

    return pytesseract.image_to_string(Image.open(io.BytesIO(content)))


def question_files(spark: SparkSession, path: str, ocr: Callable[[bytes], str] | None = None, pages: Callable[[bytes], list[str]] | None = None, broken: bool | None = False) -> DataFrame:
    """doc, kind, text: the first page of a PDF, the words of an image, or a text file; another suffix fails the query. With ``broken`` doc and error of the files that cannot be read."""
    files = contents(spark, path).withColumn("kind", file_kind(F.col("doc")))
    kind = F.coalesce("kind", F.raise_error(F.concat(F.lit("no reader for "), F.col("doc"))).cast("string"))
    known = files.select("doc", F.concat(kind, F.lit("|")).cast("binary").alias("head"), "content").select("doc", F.concat("head", "content").alias("content"))

    def rows(content: bytes) -> list[tuple]:
        kind, _, body = content.partition(b"|")
        readers = {"pdf": lambda b: (pages or pdf_pages)(b)[0], "image": ocr or image_text, "text": lambda b: b.decode("utf-8")}
        return [(kind.decode(), readers[kind.decode()](body))]

    return read_files(known, rows, "kind string, text string", broken)
