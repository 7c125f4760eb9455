"""Text, hashing and naming functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.once import let

# Patterns, in Java's dialect
DIAGRAM = r"(?i)(?:figure|fig\.|diagram|chart|graph|image)\s+\d+"
QUESTION_NUMBER = r"(?i)(?:Question|Q)\s*(\d+)"
SPACE = r"(?U)\s+"
OBJECT_ID = r"^[0-9a-fA-F]{24}$"
ANSWER_KEY_MARKS = ("Answer Key", "Question Alignment")
LEVELS = {"Remembering": 1, "Understanding": 2, "Applying": 3, "Analyzing": 4, "Evaluating": 5}


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(c, SPACE, " ")), F.lit(""))


def canonical_text(*parts: Column) -> Column:
    """The non-empty parts, trimmed, joined by one space, with runs of Unicode white space as one."""
    kept = F.filter(F.array(*[blank(p) for p in parts]), lambda p: p != "")
    return F.array_join(kept, " ")


def content_hash(text: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def dedup_hash(text: Column) -> Column:
    """As content_hash, but null where there is no text, so that such rows drop out."""
    return let(text, lambda t: F.when(t != "", F.sha2(t, 256)))


def document_hash(columns: list[str], without: tuple[str, ...] = ("_id",)) -> Column:
    """Hash of a row's content: names in order, null told from missing text, arrays in their order."""
    kept = sorted(c for c in columns if c not in without)
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in kept]), {"ignoreNullFields": "false"}), 256)


def has_diagram(text: Column) -> Column:
    return F.coalesce(text.rlike(DIAGRAM), F.lit(False))


def question_number(text: Column) -> Column:
    """The first number after Question or Q, null without one."""
    found = F.regexp_extract_all(text, F.lit(QUESTION_NUMBER), F.lit(1))
    return F.try_element_at(found, F.lit(1)).try_cast("int")


def lenient_int(text: Column) -> Column:
    """Integers with spaces and a sign; null for anything else, such as 3.7."""
    return let(text, lambda t: F.when(t.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(t).try_cast("int")))


def is_answer_key(text: Column) -> Column:
    a, b = ANSWER_KEY_MARKS
    return F.coalesce(F.contains(text, F.lit(a)) | F.contains(text, F.lit(b)), F.lit(False))


def csv(values: Column) -> Column:
    return F.array_join(F.coalesce(values, F.array().cast("array<string>")), ",")


def semantic_context(topic: Column, strategy: Column, concepts: Column, applications: Column) -> Column:
    """Four parts by single spaces; an empty part keeps its spaces."""
    empty = F.lit("")
    return F.concat(F.coalesce(topic, empty), F.lit(" "), F.coalesce(strategy, empty), F.lit(" "), csv(concepts), F.lit(" "), csv(applications))


def first_truthy(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def file_safe(name: Column) -> Column:
    return F.translate(name, " /", "__")


def molecule_file(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))


def file_kind(path: Column) -> Column:
    """pdf, image or text by suffix (upper case counts for images only); null if none of these."""
    low = F.lower(path)
    image = F.endswith(low, F.lit(".jpg")) | F.endswith(low, F.lit(".jpeg")) | F.endswith(low, F.lit(".png"))
    return F.when(F.endswith(path, F.lit(".pdf")), "pdf").when(image, "image").when(F.endswith(path, F.lit(".txt")), "text")


def subject_of_task(name: Column) -> Column:
    """The second word, in lower case."""
    return F.lower(F.get(F.split(F.trim(name), r"\s+"), F.lit(1)))


def string_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda s: F.trim(s))


def int_list(text: Column) -> Column:
    """The numbers of a comma list; what is no number drops out."""
    digits = F.filter(string_list(text), lambda s: s.rlike(r"^[0-9]+$"))
    return F.transform(digits, lambda s: s.cast("int"))


def level_number(level: Column) -> Column:
    pairs = [F.lit(x) for item in LEVELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), level)


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def batch_id(ts: Column) -> Column:
    return F.concat(F.lit("batch_"), stamp(ts))


def seed_suffix(run_seed: Column) -> Column:
    return F.element_at(F.split(run_seed, "_"), -1).try_cast("int")


def server_uri(server: Column, port: Column, user: Column, password: Column, scheme: str = "mongodb") -> Column:
    """A connection string; credentials only if both are given, a default host without a server."""
    host = F.coalesce(F.nullif(server, F.lit("")), F.lit("localhost"))
    login = F.when((F.length(user) > 0) & (F.length(password) > 0), F.concat(user, F.lit(":"), password, F.lit("@"))).otherwise(F.lit(""))
    return F.concat(F.lit(f"{scheme}://"), login, host, F.lit(":"), F.coalesce(port, F.lit("27017")))
