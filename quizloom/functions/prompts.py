"""Prompt templates compiled to column expressions, and the sections that go into them."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.once import let

# Headings and prefixes of prompts
OBJECTIVES_HEADING = "### Learning Objectives:\n"
SAMPLES_HEADING = "### Sample Questions:\n"
SAMPLE_LABEL, STEPS_LABEL, QUESTION_LABEL = "Question ", "Diagram Instructions: ", "Question: "
MODEL_PREFIX = "You are "

NO_OBJECTIVES = "No specific learning objectives are given."
NO_SOLUTION = "Draw the figure only; do not solve the question."


def render(template: str, params: Mapping[str, Column]) -> Column:
    """``str.format`` with names only, as a concat: values are not scanned again, ``{{`` is ``{``.

    A name without a column raises KeyError when the plan is made; a null value makes the row's prompt null.
    """
    parts: list[Column] = []
    for text, name, spec, conversion in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            if spec or conversion or not name.isidentifier():
                raise ValueError(f"only plain names are templates' fields: {name!r}")
            parts.append(params[name].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


#: The parts of a template: doubled braces, a field, other text, a brace that stands alone.
PART = r"\{\{|\}\}|\{[^{}]*\}|[^{}]+|[{}]"


def render_rows(template: Column, params: Column) -> Column:
    """``render`` for templates that are data: each row's template is cut into literal and name parts, which a map of strings fills.

    A name that the map lacks, a field that is no plain name, and a single brace fail the query; a null template or value makes the row's prompt null.
    """

    def fill(part: Column) -> Column:
        name = F.substring(part, F.lit(2), F.length(part) - 2)
        bad = F.when(name.rlike(r"^[A-Za-z_]\w*$"), F.lit("no value for the field ")).otherwise(F.lit("only plain names are templates' fields: "))
        known = F.coalesce(F.map_contains_key(params, name), F.lit(False))
        value = F.when(known, F.try_element_at(params, name)).otherwise(F.raise_error(F.concat(bad, part)).cast("string"))
        text = F.when(part == "{{", "{").when(part == "}}", "}").when(part.isin("{", "}"), F.raise_error(F.concat(F.lit("a single brace in the template: "), template)).cast("string"))
        return text.when(part.startswith("{"), value).otherwise(part)

    filled = F.transform(F.regexp_extract_all(template, F.lit(PART), F.lit(0)), fill)
    return let(filled, lambda parts: F.when(F.forall(parts, lambda p: p.isNotNull()), F.array_join(parts, "")))


def numbered(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v, i: F.concat((i + 1).cast("string"), F.lit(". "), v)), "\n")


def bullets(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit("- "), v)), "\n")


def objectives_section(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.concat(F.lit(OBJECTIVES_HEADING), numbered(values))).otherwise(NO_OBJECTIVES)


def system_objectives(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.concat(F.lit(f"\n{OBJECTIVES_HEADING}"), bullets(values))).otherwise("")


def user_objectives(values: Column) -> Column:
    return F.when(F.size(values) > 0, bullets(values)).otherwise(NO_OBJECTIVES)


def sample_section(questions: Column) -> Column:
    """Numbered from 1; empty without questions."""
    listed = F.array_join(F.transform(questions, lambda q, i: F.concat(F.lit(SAMPLE_LABEL), (i + 1).cast("string"), F.lit(": "), q)), "\n")
    return F.when(F.size(questions) > 0, F.concat(F.lit(f"\n{SAMPLES_HEADING}"), listed)).otherwise("")


def with_constraints(prompt: Column, run_seed: Column) -> Column:
    rules = "\n\nConstraints:\n- Ask nothing twice, not in other words either.\n- Spread over topics, skills and difficulty.\n- Take another angle for run_seed="
    return F.concat(prompt, F.lit(rules), run_seed.cast("string"), F.lit(".\n"))


def diagram_prompt(question: Column, steps: Column) -> Column:
    drawn = F.when(F.length(steps) > 0, F.concat(F.lit(f"\n\n{STEPS_LABEL}"), steps)).otherwise("")
    return F.concat(F.lit(QUESTION_LABEL), question, drawn, F.lit(f"\n\n{NO_SOLUTION}"))


def for_provider(system_prompt: Column, provider: Column, model: Column, named: tuple[str, ...] = ("gemini", "anthropic")) -> Column:
    """Some providers are told the model's name first."""
    return F.when(provider.isin(*named), F.concat(F.lit(MODEL_PREFIX), model, F.lit(". "), system_prompt)).otherwise(system_prompt)
