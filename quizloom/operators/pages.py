"""Pages of documents: text, question numbers, answer keys and what blank pages inherit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.functions.once import let, with_once
from quizloom.functions.text import has_diagram, is_answer_key, lenient_int, question_number
from quizloom.operators.lookup import last_by


def full_text(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """doc, full_text: non-blank pages in order, joined by line ends; null if all are blank."""
    kept = F.collect_list(F.when(F.trim(text) != "", F.struct(F.col(page).alias("p"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(F.array_sort(kept), lambda s: s["t"]), "\n")
    return pages.groupBy(doc).agg(F.nullif(F.trim(joined), F.lit("")).alias("full_text"))


def answer_key(rows: DataFrame, doc: str = "doc", order: str = "row_ord", cells: str = "cells") -> DataFrame:
    """doc, question_num, answer, skill, learning_objective, unit from table rows of five cells or more.

    Rows whose number or unit is no integer, or with a null among the five cells, go; of equal numbers the last row counts.
    """
    names = ["question_num", "answer", "skill", "learning_objective", "unit"]
    kinds = [lenient_int, F.trim, F.trim, F.trim, lenient_int]

    def parsed(c: Column) -> Column:
        read = F.struct(*[kind(F.get(c, F.lit(i))).alias(n) for i, (n, kind) in enumerate(zip(names, kinds, strict=True))])
        return F.when(F.size(c) >= len(names), read)

    def whole(r: Column) -> Column:
        return ~F.exists(F.array(*[r[n].isNull() for n in names]), lambda missing: missing)

    good = with_once(rows.select(doc, order, cells), "__read", let(F.col(cells), parsed), whole).select(doc, order, "__read.*")
    return last_by(good, [doc, "question_num"], order).drop(order)


def page_flags(pages: DataFrame, text: str = "text") -> DataFrame:
    """Adds diagram_required and question_number; pages of an answer key go."""
    rows = pages.where(~is_answer_key(F.col(text)))
    return rows.withColumn("diagram_required", has_diagram(F.col(text))).withColumn("question_number", question_number(F.col(text)))


def align(pages: DataFrame, key: DataFrame, doc: str = "doc") -> DataFrame:
    """Adds the answer-key fields of the page's question; without a number, or for number 0, texts are empty and unit is null."""
    known = key.withColumnRenamed("question_num", "question_number")
    out = pages.join(known, (pages[doc] == known[doc]) & (pages.question_number == known.question_number) & (pages.question_number != 0), "left")
    texts = [F.coalesce(known[c], F.lit("")).alias(c) for c in ("answer", "skill", "learning_objective")]
    return out.select(*[pages[c] for c in pages.columns], *texts, known.unit)


def carry_forward(pages: DataFrame, fields: list[str], has_text: Column, doc: str, *order: str) -> DataFrame:
    """Blank pages take the fields of the last page with text before them, its nulls too; leading blank pages go."""
    own = F.when(has_text, F.struct(*fields))
    window = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = pages.withColumn("__from", F.last(own, ignorenulls=True).over(window)).where("__from IS NOT NULL")
    return carried.select(*[c for c in pages.columns if c not in fields], *[F.col(f"__from.{f}").alias(f) for f in fields])


def labelled_text(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, rec, question, answer, options: records of lines ``Q:``, ``A:``, ``Options:`` and their longer names.

    A question line opens a record; of repeated answer or options lines the last counts; lines before the first question go.
    """
    line = texts.select(key, F.posexplode(F.split(text, "\n")).alias("at", "line")).withColumn("line", F.trim("line"))
    marks = {"question": r"^(?:Q:|Question:|q:)", "answer": r"^(?:A:|Answer:|a:)", "options": r"^(?:Options:|Choices:|options:)"}
    kind = F.coalesce(*[F.when(F.col("line").rlike(m), n) for n, m in marks.items()])
    line = line.withColumn("kind", kind).where("kind IS NOT NULL")
    line = line.withColumn("value", F.trim(F.regexp_replace("line", r"^[A-Za-z]+:", "")))
    rec = F.sum(F.when(F.col("kind") == "question", 1).otherwise(0)).over(Window.partitionBy(key).orderBy("at"))
    line = line.withColumn("rec", rec).where("rec > 0")
    last = {n: F.max_by("value", F.when(F.col("kind") == n, F.col("at"))).alias(n) for n in marks}
    out = line.groupBy(key, "rec").agg(*last.values())
    return out.withColumn("options", F.transform(F.split("options", ","), lambda o: F.trim(o)))
