"""Functions and operators on hand-made rows with expected results."""

from __future__ import annotations

import hashlib
import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizloom.functions import choices, jsonfix, prompts, text
from quizloom.operators import bank, dedup, delta, framework, lookup, pages, summary

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_canonical_text(spark):
    rows = [("What is\u00a0 2+2?", None, None), (" What is 2+2? ", "", None), (None, "What is", "2+2?"), (None, None, "T"), ("   ", None, None), (None, None, None)]
    canonical = text.canonical_text(F.col("q"), F.col("s"), F.col("t"))
    got = values(spark, rows, "q string, s string, t string", canonical, text.dedup_hash(canonical), text.content_hash(canonical))
    assert [g[0] for g in got] == ["What is 2+2?"] * 3 + ["T", "", ""]
    assert got[0][1][:16] == "52cb6b5e4a038af1" and got[3][1][:16] == "e632b7095b0bf32c" and got[4][1] is None and got[5][2][:16] == "e3b0c44298fc1c14"


@pytest.mark.parametrize(("page", "flag", "number"), [
    ("see Figure 3", True, None), ("fig. 2", True, None), ("fig 2", False, None), ("FAQ 3", False, 3), ("Question 12 and Q4", False, 12), ("config graph  7", True, None), ("Question0", False, 0), (None, False, None), ("Q 99999999999", False, None)])
def test_page_patterns(spark, page, flag, number):
    assert values(spark, [(page,)], "t string", text.has_diagram(F.col("t")), text.question_number(F.col("t"))) == [(flag, number)]


def test_sanitizers(spark):
    raws = ["```json\n{\"q\":\"\\alpha\"}\n```", "```JSON\n{\"q\":\"\\frac{1}{2}\"}\n```", '{"q":"\\\\alpha"}', '{"q":"\\u2019"}', '{"q":']
    got = values(spark, [(r,) for r in raws], "r string", jsonfix.sanitize_exam(F.col("r")), jsonfix.sanitize_bank(F.col("r")))

    def parsed(t):
        try:
            return json.loads(t)["q"]
        except ValueError:
            return None

    assert [parsed(g[0]) for g in got] == ["\\alpha", "\frac{1}{2}", "\\alpha", "\u2019", None]
    assert [parsed(g[1]) for g in got] == ["\\alpha", None, "\\alpha", "\\u2019", None]


@FEW
@given(st.lists(st.text(alphabet='\\ntrbfu"/a x`', max_size=12), min_size=20, max_size=40))
def test_sanitizers_like_re(spark, raws):
    def exam(r):
        c = r.strip().strip("`")
        c = c[4:].strip() if c.lower().startswith("json") else c
        return re.sub(r'(?<!\\)\\(?![\\/"bfnrtu])', r"\\\\", c.strip("`"))

    got = values(spark, [(r,) for r in raws], "r string", jsonfix.sanitize_exam(F.col("r")))
    assert [g[0] for g in got] == [exam(r) for r in raws]


def test_root_shapes(spark):
    raws = ['[{"a":1},{"a":2}]', '{"questions":[{"a":1}]}', '{"a":1}', '[1,{"a":1}]', "7", "{", None, '{"cheat_sheet":{"t":1}}']
    v = jsonfix.parse(F.col("r"))
    got = values(spark, [(r,) for r in raws], "r string", F.size(jsonfix.items(v)), jsonfix.unwrap(F.col("r")))
    assert [g[0] for g in got][:4] == [2, 1, 1, 1] and all(g[0] in (None, -1) for g in got[4:7])
    assert got[7][1] == '{"t":1}' and json.loads(got[5][1]) == {"raw_content": "{"}


@FEW
@given(st.lists(st.text(alphabet="xyz", min_size=1, max_size=3), min_size=4, max_size=4), st.integers(0, 3), st.integers(0, 10**6))
def test_shuffle_keeps_options_and_answer(spark, texts, right, key):
    labelled = [f"{c}{'.' if k % 2 else ')'} {t}" for k, (c, t) in enumerate(zip("ABCD", texts, strict=True))]
    row = values(spark, [(labelled, "ABCD"[right], key)], "c array<string>, a string, k long", choices.shuffled(F.col("c"), F.col("a"), F.col("k"), "s"))[0][0]
    new = [c[3:] for c in row.choices]
    assert sorted(new) == sorted(texts) and [c[:3] for c in row.choices] == ["A. ", "B. ", "C. ", "D. "]
    assert "ABCD".index(row.answer) == new.index(texts[right])


def test_shuffle_quarantine(spark):
    assert values(spark, [(["x", "A. y"], "A"), (["A. x", "B. y"], "F"), (None, "A")], "c array<string>, a string", choices.shuffled(F.col("c"), F.col("a"), F.lit(1), "s")) == [(None,), (None,), (None,)]


def test_templates(spark):
    body = prompts.render("Hi {name}, {{x}}", {"name": F.col("n"), "other": F.lit(1)})
    assert values(spark, [("{y}",), (None,)], "n string", body) == [("Hi {y}, {x}",), (None,)]
    with pytest.raises(KeyError):
        prompts.render("{missing}", {})
    assert values(spark, [([],), (["a", "b"],)], "o array<string>", prompts.objectives_section(F.col("o"))) == [(prompts.NO_OBJECTIVES,), ("### Learning Objectives:\n1. a\n2. b",)]


def test_lookup_ids(spark):
    skills = spark.createDataFrame([(1, "Limits"), (2, "Series"), (3, "Orphan")], "skill_id long, skill_name string")
    tasks = spark.createDataFrame([(1, "T2"), (1, "T1"), (2, "T1")], "skill_id long, task_name string")
    got = lookup.lookup_ids(spark, [2, 1, 1, 9, 3], skills, tasks, "skill_id", "task_name").orderBy("pos").collect()
    assert [(r.skill_id, r.task_name) for r in got] == [(2, "T1"), (1, "T1"), (1, "T1"), (3, None)]


def test_unit_objectives(spark):
    spark.sql("""CREATE OR REPLACE TEMP VIEW raw_frames AS SELECT 0 AS ord, 'S' AS subject, array(named_struct('unit', 'U', 'topics', array(
        named_struct('topic', 't1', 'objectives', array(parse_json('"a"'), parse_json('{"description":"b"}'), parse_json('{"description":""}'), parse_json('{"x":1}'), parse_json('null'))),
        named_struct('topic', 't2', 'objectives', cast(array() AS array<variant>)), named_struct('topic', 't3', 'objectives', cast(NULL AS array<variant>))))) AS units""")
    frames = spark.table("raw_frames")
    found = framework.unit_objectives(frames, "S", "U").orderBy("framework_ord", "topic_pos", "objective_pos").collect()
    assert [r.objective for r in found] == ["a", "b"] and framework.unit_objectives(frames, "S", "none").collect() == []
    skills = spark.createDataFrame([(1, "S", "U"), (2, "S", "none"), (3, "S", "U")], "skill_id int, subject string, unit string")
    assert sorted((r.skill_id, r.objective or "") for r in framework.objectives_for(skills, frames).collect()) == [(1, "a"), (1, "b"), (2, ""), (3, "a"), (3, "b")]
    assert frames.select(framework.flat_objectives(F.col("units")[0]["topics"]).alias("o")).collect()[0].o == ["a", "b"]


def test_allocation(spark):
    rows = [("a", 10.0), ("b", 15.0), ("c", 12.5), ("d", 7.0), ("e", 0.0), ("f", None)]
    units = spark.createDataFrame(rows, "unit string, weight double")
    assert {r.unit: r.n_questions for r in framework.allocate(units, 44).collect()} == {"a": 5, "b": 7, "c": 6, "d": 4}
    assert framework.allocate(units.withColumn("weight", F.lit(0.0)), 44).collect() == []


def test_fill(spark, tmp_path):
    wanted = spark.createDataFrame([("u", 3), ("v", 2)], "unit string, want long")
    answers = [[("u", "x", 0), ("u", "x", 1), ("v", "x", 0), ("v", "y", 1), ("v", "z", 2)], [("u", "y", 0), ("u", "p", 1)], [("u", "q", 0), ("u", "r", 1)]]
    save = lambda df, tag: (df.write.parquet(f"{tmp_path}/{tag}"), spark.read.parquet(f"{tmp_path}/{tag}"))[1]
    out = dedup.fill(wanted, lambda short, n: spark.createDataFrame(answers[n], "unit string, hash string, pos int").join(short.select("unit"), "unit"), "unit", "hash", "pos", save)
    got = sorted((r.unit, r.hash) for r in out.collect())
    assert got == [("u", "p"), ("u", "q"), ("u", "x"), ("v", "y"), ("v", "z")]


def test_answer_key(spark):
    rows = [("d", 0, ["Q", "Answer", "Skill", "LO", "Unit"]), ("d", 1, [" 7 ", " B ", "s", "lo", " 2 "]), ("d", 2, ["x", "A", "s", "lo", "1"]), ("d", 3, ["8", "A", "s", "lo"]), ("d", 4, ["9", "A", "s", "lo", "3.7"]), ("d", 5, ["10", None, "s", "lo", "1"]), ("d", 6, ["7", "C", "s", "lo", "3"])]
    got = pages.answer_key(spark.createDataFrame(rows, "doc string, row_ord int, cells array<string>")).collect()
    assert [tuple(r) for r in got] == [("d", 7, "C", "s", "lo", 3)]


def test_carry_forward(spark):
    texts = [None, "Q 7 figure 2", " ", "Answer Key 1", "", "no number", None]
    df = spark.createDataFrame([("d", i + 1, t) for i, t in enumerate(texts)], "doc string, page_number int, text string")
    flagged = pages.page_flags(df)
    got = pages.carry_forward(flagged, ["question_number"], F.trim("text") != "", "doc", "page_number").orderBy("page_number").collect()
    assert [(r.page_number, r.question_number, r.diagram_required) for r in got] == [(2, 7, True), (3, 7, False), (5, 7, False), (6, None, False), (7, None, False)]


def test_delta(spark):
    schema = "_id string, question_id int, a int, b array<int>"
    source = spark.createDataFrame([("x", 1, 1, None), ("y", 2, 2, None), ("z", 3, 3, [1, 2]), ("w", None, 9, None)], schema)
    target = spark.createDataFrame([("q", 2, 2, None), ("r", 3, 3, [2, 1]), ("s", 4, 4, None)], schema)
    sides = [d.select("question_id", text.document_hash(d.columns).alias("h")) for d in (source, target)]
    classes = {r.question_id: r.status for r in delta.classify(*sides, "question_id", "h").collect()}
    assert classes == {1: "added", 2: "same", 3: "changed", 4: "deleted"}
    assert {r.question_id for r in delta.apply_added(source, target, "question_id").collect()} == {1, 2, 3, 4}
    assert delta.apply_added(source, target, "question_id", dry_run=True).count() == 3
    same = delta.stats(delta.classify(sides[0], sides[0], "question_id", "h")).collect()[0]
    assert tuple(same) == (0, 0, 0)


def test_summary(spark):
    log = spark.createDataFrame([("s", True), ("s", True), ("s", False), ("t", False)], "subject string, success boolean")
    got = {r.subject: (r.successful, r.failed, r.success_rate, r.success) for r in summary.summarise(log, "subject").collect()}
    assert got == {"s": (2, 1, "66.7%", True), "t": (0, 1, "0.0%", False)}


def test_batches(spark):
    got = lookup.batches(spark.range(1003).withColumnRenamed("id", "k"), 100, "k").groupBy("batch").agg(F.count("*").alias("n"), F.min("k").alias("lo")).orderBy("batch").collect()
    assert [(r.batch, r.n, r.lo) for r in got] == [(i, 100 if i < 10 else 3, 100 * i) for i in range(11)]


def test_dedup_is_idempotent(spark):
    rows = spark.createDataFrame([(i, hashlib.md5(str(i % 5).encode()).hexdigest() if i % 7 else None) for i in range(40)], "pos int, hash string")
    once = dedup.first_seen(rows, "hash", "pos")
    assert sorted(once.collect()) == sorted(dedup.first_seen(once, "hash", "pos").collect()) and once.count() == 5
    assert dedup.unseen(rows, once, "hash").where("hash IS NOT NULL").count() == 0


def test_vector_record(spark):
    df = spark.createDataFrame([(1, "t", ["a", "b"], None)], "id int, topic string, k array<string>, d string")
    got = bank.vector_record(df, F.col("id").cast("string"), F.col("topic"), {"keywords": F.col("k")}, {"difficulty": (F.col("d"), "Medium"), "semantic_context": (text.semantic_context(F.col("topic"), F.col("d"), F.col("k"), F.lit(None).cast("array<string>")), "")}).collect()[0]
    assert tuple(got) == ("1", "t", "a,b", "Medium", "t  a,b ")


def test_templates_as_rows(spark):
    import string

    bodies = ["Hi {name}, {{x}} {{{name}}}", "", "{name}{name}", "no field", "{}", "{0}", "{a.b}", "a } b", "{ a", "{missing}", "{{missing}}", "{name!r}", None, "{none}"]
    params = F.create_map(F.lit("name"), F.lit("N{x}"), F.lit("none"), F.lit(None).cast("string"))
    for body in bodies:
        made = lambda body=body: values(spark, [(body,)], "t string", prompts.render_rows(F.col("t"), params))[0][0]
        try:
            fields = [(n, s, c) for _, n, s, c in string.Formatter().parse(body or "") if n is not None]
            good = all(n in ("name", "none") and not s and not c for n, s, c in fields)
        except ValueError:
            good = False
        if not good:
            with pytest.raises(Exception, match="plain names|no value|single brace"):
                made()
        else:
            assert made() == (None if body in (None, "{none}") else body.format(name="N{x}"))


def test_field_changes_neither_join_nor_broadcast(spark):
    """Repeated keys count by their greatest value, empty documents have a key but no field, rows without key are on neither side."""
    src = [(1, '{"a":1}'), (2, "{}"), (3, '{"a":null,"b":2}'), (3, '{"a":7}'), (4, '{"a":1}'), (None, '{"a":1}'), (6, None), (7, "5")]
    tgt = [(1, '{"a":2}'), (2, '{"x":null}'), (3, '{"b":2}'), (5, '{"a":1}'), (None, '{"a":2}'), (6, '{"a":1}'), (7, '{"a":1}')]
    sides = [spark.createDataFrame(rows, "id int, d string").selectExpr("id", "parse_json(d) AS doc") for rows in (src, tgt)]
    out = delta.field_changes(*sides, "id", "doc")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "changed"), (2, "x", "removed"), (3, "a", "added"), (6, "a", "removed"), (7, "a", "removed")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_responses_are_parsed_once(spark):
    """Generators compute what they are given as often as it is written, so it is written once."""
    rows = spark.createDataFrame([(1, '```json\n{"questions":[{"a":1},2]}\n```'), (2, '[{"b":2}, [1]]'), (3, '{"questions":null,"c":3}'), (4, '"[]"'), (5, None)], "id int, r string")
    for sanitize in (jsonfix.sanitize_exam, jsonfix.sanitize_bank):
        out = bank.questions_of(rows, "r", sanitize).select("id", "pos", F.to_json("q").alias("q"))
        plan = out._jdf.queryExecution().analyzed().toString()
        assert plan.count("parse_json(") == 1
        assert {(r.id, r.pos, r.q) for r in out.collect()} == {(1, 0, '{"a":1}'), (2, 0, '{"b":2}'), (3, 0, '{"c":3,"questions":null}')}
