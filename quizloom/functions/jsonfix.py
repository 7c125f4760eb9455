"""Repair, parsing and shape normalisation of model-made JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.once import let

# Patterns, in Java's dialect
FENCES = r"\A```json|```\z"
LONE_BACKSLASH_EXAM = r'(?<!\\)\\(?![\\/"bfnrtu])'
LONE_BACKSLASH_BANK = r'(?<!\\)\\(?![\\ntr"/])'
TWO_BACKSLASHES = r"\\\\"
TICKS = r"\A`+|`+\z"
# What parts an answer about an image
IMAGE_SEPARATOR, QUESTION_MARK, DETAILS_MARK = "---", "**Extracted Question:**", "**Image Details:**"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def strip_fences(text: Column) -> Column:
    return strip_space(F.regexp_replace(strip_space(text), FENCES, ""))


def sanitize_exam(text: Column) -> Column:
    """Ticks and a ``json`` tag in any case go, then lone backslashes double, but those of JSON escapes."""
    bare = let(F.regexp_replace(strip_space(text), TICKS, ""), lambda t: F.when(t.rlike(r"(?i)\Ajson"), strip_space(F.substring(t, 5, 1 << 30))).otherwise(t))
    return F.regexp_replace(F.regexp_replace(bare, TICKS, ""), LONE_BACKSLASH_EXAM, TWO_BACKSLASHES)


def sanitize_bank(text: Column) -> Column:
    """Lone backslashes double first (escapes of b, f and u too), then ticks and a lower-case ``json`` tag go."""
    doubled = F.regexp_replace(strip_space(text), LONE_BACKSLASH_BANK, TWO_BACKSLASHES)
    return let(F.regexp_replace(doubled, TICKS, ""), lambda t: F.when(t.startswith("json"), strip_space(F.substring(t, 5, 1 << 30))).otherwise(t))


def parse(text: Column) -> Column:
    """VARIANT, null if the text is no JSON."""
    return F.try_parse_json(text)


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def items(v: Column) -> Column:
    """array<variant>: a list's items, the items of ``questions``, or the object alone; objects only. Null for unparsed text and scalars."""
    listed = F.try_variant_get(v, "$", "array<variant>")  # null for all else, and so are the questions of what is no object
    questions = F.try_variant_get(v, "$.questions", "array<variant>")
    found = F.coalesce(listed, questions, F.when(is_object(v), F.array(v)))
    return F.filter(found, is_object)


def unwrap(text: Column, wrapper: str = "cheat_sheet") -> Column:
    """JSON text of the wrapped object if there is one, else of the whole; ``{"raw_content": text}`` if it is no JSON."""
    v = parse(text)
    inner = F.when(is_object(v), F.try_variant_get(v, f"$.{wrapper}", "variant"))
    return F.coalesce(F.to_json(F.coalesce(inner, v)), F.to_json(F.struct(text.alias("raw_content"))))


def whole(text: Column) -> Column:
    """JSON text with any wrapper kept; ``{"raw_content": text}`` if it is no JSON."""
    return F.coalesce(F.to_json(parse(text)), F.to_json(F.struct(text.alias("raw_content"))))


def field(v: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{name}", kind)


def presence(v: Column, name: str) -> Column:
    """``missing`` if the object has no such field, ``null`` if it has it with a null, else ``value``."""
    found = F.try_variant_get(v, f"$.{name}", "variant")
    return F.when(found.isNull(), "missing").when(F.is_variant_null(found), "null").otherwise("value")


def objective_text(v: Column) -> Column:
    """A string as it is, an object's non-empty description, else null."""
    text = F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return F.coalesce(text, F.when(is_object(v), F.nullif(F.try_variant_get(v, "$.description", "string"), F.lit(""))))


def text_or_list(v: Column) -> Column:
    """A list's items by spaces, anything else as text."""
    return F.when(is_list(v), F.array_join(F.try_variant_get(v, "$", "array<string>"), " ")).otherwise(F.try_variant_get(v, "$", "string"))


def image_text(text: Column) -> Column:
    """struct<question, details> of an answer that a line of dashes may part; markers go."""
    parts = F.split(text, IMAGE_SEPARATOR)
    question = strip_space(F.replace(F.get(parts, F.lit(0)), F.lit(QUESTION_MARK), F.lit("")))
    details = strip_space(F.replace(F.get(parts, F.lit(1)), F.lit(DETAILS_MARK), F.lit("")))
    return F.struct(question.alias("question"), F.coalesce(details, F.lit("")).alias("details"))
