"""Question rows: exploding sets, enrichment, quarantine, vector records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions import jsonfix, text
from quizloom.functions.once import let


def questions_of(responses: DataFrame, raw: str, sanitize=jsonfix.sanitize_exam) -> DataFrame:
    """One row for each question object of a response, with pos (from 0) and q (variant); unreadable responses give none."""
    # generators repeat what their argument repeats, so each step is computed once
    found = let(F.col(raw), lambda r: let(jsonfix.parse(sanitize(r)), jsonfix.items))
    return responses.select(*[c for c in responses.columns if c != raw], F.posexplode(found).alias("pos", "q"))


def quarantine(responses: DataFrame, raw: str, sanitize=jsonfix.sanitize_exam) -> DataFrame:
    """Responses that are no JSON or hold no object, with the reason."""
    v = jsonfix.parse(sanitize(F.col(raw)))
    found = jsonfix.items(v)
    reason = F.when(v.isNull(), "not JSON").when(F.coalesce(F.size(found), F.lit(0)) <= 0, "no question")
    return responses.withColumn("reason", reason).where("reason IS NOT NULL")


def enrich(questions: DataFrame, pos: str, set_ord: str, created_at: Column) -> DataFrame:
    """Adds question_index (from 1 in its set), set_index (the set's own place), batch_id and created_at, one for the run."""
    return questions.select("*", (F.col(pos) + 1).alias("question_index"), F.col(set_ord).alias("set_index"), text.batch_id(created_at).alias("batch_id"), created_at.alias("created_at"), F.lit("tests").alias("question_type"))


def vector_record(rows: DataFrame, record_id: Column, document: Column, lists: dict[str, Column], scalars: dict[str, tuple[Column, object]]) -> DataFrame:
    """question_id, document, lists as comma-separated text, scalars with their defaults."""
    cols = [text.csv(c).alias(n) for n, c in lists.items()] + [F.coalesce(c, F.lit(d)).alias(n) for n, (c, d) in scalars.items()]
    return rows.select(record_id.alias("question_id"), document.alias("document"), *cols)


def stamp_metadata(rows: DataFrame, diagram: Column, model: Column, source: Column) -> DataFrame:
    """Replaces metadata by (source, has_diagram), as the structuring step does, beside the flag and the model."""
    return rows.withColumns({"diagram_required": diagram, "model_used": model, "metadata": F.struct(source.alias("source"), diagram.alias("has_diagram"))})


def merge_alignment(alignment: Column, fields: dict[str, Column], number: Column) -> Column:
    """The struct with fields replaced; question_number only where it is not 0 or null."""
    out = alignment
    for name, value in fields.items():
        out = out.withField(name, value)
    return out.withField("question_number", F.when(number != 0, number))
