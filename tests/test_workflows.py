"""Sources, sinks, providers, workflows and streams, with the offline provider and small files."""

from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F

from quizloom.functions import text
from quizloom.plans import workflows
from quizloom.sources import bank, config, files, providers
from quizloom.sources.seen import SeenState
from quizloom.streaming import sync_batches, unique_questions, windowed_counts


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame([(1, "Limits", 60.0, ["a", "b"]), (2, "Series", 30.0, []), (3, "None", 0.0, ["c"])], "unit_id int, unit string, weight double, objectives array<string>")


def test_exam(spark, units):
    rows = workflows.exam(spark, units, "Maths", 10, "2024-01-02 03:04:05").collect()
    assert sorted((r.unit_id, r.question_index) for r in rows) == [(1, i) for i in range(1, 7)] + [(2, i) for i in range(1, 4)]
    assert len({r.hash for r in rows}) == 9 and {r.batch_id for r in rows} == {"batch_20240102_030405"}


def test_exam_retries(spark, units):
    """The first attempt repeats itself; the next one fills up. Hashes of an earlier run do not come back."""

    def stubborn(provider, system, user, settings):
        again = "05_0" in user
        return json.dumps({"questions": [{"question": "same"}] * 6}) if again else json.dumps({"questions": [{"question": f"{user[-40:]} {i}"} for i in range(int(settings["num_questions"]))]})

    seen = spark.createDataFrame([("x",)], "hash string").select(F.sha2(F.lit("same"), 256).alias("hash"))
    one = workflows.exam(spark, units.where("unit_id = 1"), "Maths", 10, "2024-01-02 03:04:05", call=stubborn).collect()
    two = workflows.exam(spark, units.where("unit_id = 1"), "Maths", 10, "2024-01-02 03:04:05", seen=seen, call=stubborn).collect()
    assert sum(r.question == "same" for r in one) == 1 and len(one) == 6
    assert sum(r.question == "same" for r in two) == 0 and len(two) == 6


def test_skill_levels_and_enhance(spark):
    skills = spark.createDataFrame([(1, "Limits", ["a"]), (2, "Series", [])], "skill_id int, skill string, objectives array<string>")
    made = workflows.skill_levels(spark, skills, text.LEVELS, 3)
    assert made.count() == 2 * 5 * 3
    better = workflows.enhance(spark, made.limit(4), skills)
    assert all(json.loads(r.enhanced)["questions"] for r in better.collect())


def test_cheat_sheets(spark):
    topics = spark.createDataFrame([("s", "t1", ["a"]), ("s", "t2", []), ("s", "t3", ["b"])], "subject string, topic string, objectives array<string>")
    fails = lambda p, s, u, k: None if "t3" in u else '```json\n{"cheat_sheet": {"title": "x"}}\n```'
    sheets, summary = workflows.cheat_sheets(spark, topics, call=fails)
    got = {r.topic: (r.success, r.error, r.cheat_sheet) for r in sheets.collect()}
    assert got == {"t1": (True, None, '{"title":"x"}'), "t2": (False, "framework", None), "t3": (False, "model", None)}
    assert summary.collect()[0].success_rate == "33.3%"


def test_extract_and_similar(spark):
    pages = spark.createDataFrame([("d", 1, "Question 7 see Figure 1"), ("d", 2, " "), ("d", 3, "Answer Key")], "doc string, page_number int, text string")
    key = spark.createDataFrame([("d", 1, ["7", "B", "s", "lo", "2"])], "doc string, row_ord int, cells array<string>")
    rows = workflows.extract(spark, pages, key, "T").collect()
    assert {(r.page_number, r.question_number, r.answer, r.unit) for r in rows} == {(1, 7, "B", 2), (2, 7, "B", 2)}
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 for r in rows)
    samples = spark.createDataFrame([("f", " What? ")], "doc string, text string")
    assert workflows.similar(spark, samples, 2).collect()[0].raw_output is None
    assert workflows.similar(spark, samples, 2, call=lambda *a: "no json").collect()[0].raw_output == "no json"


def test_diagrams_and_shuffle(spark):
    schema = "_id string, question string, question_text string, subject string, question_type string, requires_diagram boolean, diagram_gen_steps array<string>, multiple_choices array<string>, correct_answer string"
    rows = [(str(i), f"q{i}", None, "s", "tests", i % 2 == 0, ["draw"] if i % 4 == 0 else [], [f"{c}. {c}{i}" for c in "ABCD"], "B") for i in range(12)]
    df = spark.createDataFrame(rows, schema)
    done = spark.createDataFrame([("0",)], "_id string")
    drawn = workflows.diagrams(df, done, "_id", lambda p: p.encode() if "q4" not in p else None, subject="*").collect()
    assert {r._id for r in drawn} == {"2", "4", "6", "8", "10"}
    assert next(r.content for r in drawn if r._id == "4") is None and b"Diagram Instructions: draw" in next(r.content for r in drawn if r._id == "8")
    after = {r._id: r for r in workflows.shuffle_bank(df, "_id", "x").collect()}
    for i, *_, old, answer in rows:
        new = after[i]
        assert next(c for c in new.multiple_choices if c[0] == new.correct_answer)[3:] == f"B{i}"
        assert (new.correct_answer == answer) == (new.multiple_choices == old)


def test_sync(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    target = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    after, counts = workflows.sync(source, target, "k")
    assert sorted(map(tuple, after.collect())) == [(1, "a"), (2, "c"), (3, "d")] and tuple(counts.collect()[0]) == (1, 1, 1)


def test_providers(spark):
    rows = spark.createDataFrame([("s", "u1"), ("s", "u2"), ("s", "u1")], "system_prompt string, user_prompt string")
    with pytest.raises(ValueError):
        providers.requests(rows, "nobody")
    asked = providers.requests(rows, "gemini", model="m")
    assert {r.system_prompt for r in asked.collect()} == {"You are m. s"}

    def call(provider, system, user, settings):
        if user == "u2":
            raise RuntimeError("down")
        return json.dumps(settings)

    asked = providers.requests(rows, "grok", settings={"seed": 1, "presence_penalty": 2})
    got = {r.response for r in providers.respond(asked, "grok", call).collect()}
    assert got == {None, '{"seed": 1}'}


def test_requests_differ_by_settings(spark):
    rows = spark.createDataFrame([("s", "u", 3), ("s", "u", 9), ("s", "u", 3)], "system_prompt string, user_prompt string, num_questions int")
    asked = providers.requests(rows, per_row=("num_questions",))
    assert asked.select("request_id").distinct().count() == 2
    sizes = {json.loads(r.response.strip("`json\n"))["questions"].__len__() for r in providers.respond(asked).collect()}
    assert sizes == {3, 9}
    known = providers.requests(rows, "deepseek", per_row=("num_questions",))  # not one of its settings
    assert {r.settings for r in known.collect()} == {'{"max_tokens":1000,"timeout":30}'}


def test_calls_are_spread_and_not_repeated(spark, tmp_path):
    calls, opened = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def connect():
        opened.add(1)

        def call(provider, system, user, settings):
            calls.add(1)
            return None if user == "u7" else user.upper()

        return call

    rows = spark.range(500).selectExpr("'s' AS system_prompt", "concat('u', id) AS user_prompt")
    asked, path = providers.requests(rows), f"{tmp_path}/responses"
    assert providers.respond(asked).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert providers.answers(asked, path, connect=connect, tasks=5).count() == 499 and (calls.value, opened.value) == (500, 5)
    got = providers.answers(asked, path, connect=connect, tasks=5).collect()
    assert len(got) == 499 and calls.value == 501 and {r.response for r in got} == {f"U{i}" for i in range(500) if i != 7}
    drawn = providers.images(rows.limit(3), "user_prompt", "system_prompt", connect=lambda: lambda p: p.encode())
    assert {bytes(r.content) for r in drawn.collect()} == {b"s"} and providers.embed(rows.limit(2), "user_prompt", "user_prompt", connect=lambda: lambda t: [1.0]).count() == 2


def test_failed_steps_ask_no_model(spark, tmp_path):
    topics = spark.createDataFrame([("s", "t1", ["a"]), ("s", "t2", [])], "subject string, topic string, objectives array<string>")
    calls = spark.sparkContext.accumulator(0)

    def call(provider, system, user, settings):
        calls.add(1)
        return '```json\n{"cheat_sheet": {"title": "x"}}\n```'

    sheets, _ = workflows.cheat_sheets(spark, topics, call=call, model="m", created_at="2024-01-02 03:04:05", out=f"{tmp_path}/sheets")
    got = {r.topic: (r.error, r.cheat_sheet, r.file_body) for r in sheets.collect()}
    assert calls.value == 1 and got == {"t1": (None, '{"title":"x"}', '{"cheat_sheet":{"title":"x"}}'), "t2": ("framework", None, None)}
    doc = spark.read.parquet(f"{tmp_path}/sheets").collect()
    assert [(d.content_type, d.model, d.metadata.topic, d.metadata.objectives_count) for d in doc] == [("cheat_sheet", "m", "t1", 1)]


def test_level_templates_and_sinks(spark, tmp_path):
    skills = spark.createDataFrame([(1, "Limits", ["a"])], "skill_id int, skill string, objectives array<string>")
    asked = []
    templates = {k: (f"sys {k}", f"user {k} {{skill}} {{level_num}}") for k in text.LEVELS}
    call = lambda p, s, u, k: json.dumps([{"question": f"{s}/{u}/{k['num_questions']}"}])
    made = workflows.skill_levels(spark, skills, text.LEVELS, 2, call=call, templates=templates, created_at="2024-01-02 03:04:05", out=f"{tmp_path}/q")
    assert {r.question for r in made.collect()} == {f"sys {k}/user {k} Limits {v}/2" for k, v in text.LEVELS.items()}
    assert spark.read.parquet(f"{tmp_path}/q").where("created_at = '2024-01-02 03:04:05'").count() == 5
    with pytest.raises(ValueError, match="Applying"):
        workflows.skill_levels(spark, skills, text.LEVELS, 2, templates={k: v for k, v in templates.items() if k != "Applying"})
    rows = spark.createDataFrame([(1, "q?", None, ["A. x"], "A", "Applying", 3)], "skill_id int, question string, subject string, multiple_choices array<string>, correct_answer string, level string, level_num int")
    user = "|".join(f"{{{k}}}" for k in workflows.ENHANCE_DEFAULTS)
    got = workflows.enhance(spark, rows, skills.withColumn("subject_area", F.lit("area")), call=lambda p, s, u, k: json.dumps({"u": u}), user=user).collect()
    assert json.loads(got[0].enhanced)["u"] == '|None|area|None|q?|Limits||1|["A. x"]|A|Applying|3|False|[]||[]' and not asked
    like = workflows.similar(spark, spark.createDataFrame([("f", " What? ", "T")], "doc string, text string, topic string"), 2, model="m", system="{model} {topic}", user="{num_questions}: {sample_question}", call=lambda p, s, u, k: json.dumps([s, u])).collect()
    assert json.loads(like[0].questions) == ["m T", "2: What?"]


def test_upsert_and_last_read(spark, tmp_path):
    a, b = spark.createDataFrame([("1", [1.0]), ("2", [2.0])], "id string, v array<float>"), spark.createDataFrame([("2", [3.0]), ("4", [4.0]), (None, [5.0])], "id string, v array<float>")
    bank.upsert(a, f"{tmp_path}/v", "id")
    store = bank.upsert(b, f"{tmp_path}/v", "id")
    assert sorted(map(tuple, store.read().collect())) == [("1", [1.0]), ("2", [3.0]), ("4", [4.0])]
    source = spark.createDataFrame([(1, "z", 0), (1, "a", 1), (2, "b", 0)], "k int, v string, n int")
    target = spark.createDataFrame([(1, "a", 5), (2, "c", 0), (2, "b", -1)], "k int, v string, n int")
    assert tuple(workflows.sync(source, target, "k", order="n")[1].collect()[0]) == (0, 0, 1)


def test_broken_files_are_rows(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, body in (("a.pdf", b"one"), ("b.pdf", b"bad"), ("c.txt", b"text"), ("d.txt", b"\xff")):
        (tmp_path / "d" / name).write_bytes(body)

    def reader(content):
        if content == b"bad":
            raise KeyError("broken")
        return [content.decode()]

    path = f"{tmp_path}/d"
    assert {r.text for r in files.question_files(spark, path, pages=reader).collect()} == {"one", "text"}
    assert {r.doc[-5:]: r.error.split(":")[0] for r in files.question_files(spark, path, pages=reader, broken=True).collect()} == {"b.pdf": "KeyError", "d.txt": "UnicodeDecodeError"}
    assert [r.error for r in files.binary_pages(spark, f"{path}/b.pdf", reader, broken=True).collect()] == ["KeyError: 'broken'"]
    assert files.binary_tables(spark, f"{path}/b.pdf", reader, broken=True).count() == 1
    both = files.question_files(spark, path, pages=reader, broken=None).collect()  # one pass for good and broken
    assert {(r.doc[-5:], r.text, (r.error or "").split(":")[0]) for r in both} == {("a.pdf", "one", ""), ("b.pdf", None, "KeyError"), ("c.txt", "text", ""), ("d.txt", None, "UnicodeDecodeError")}


def test_molecules(monkeypatch):
    """SMILES as they are, names by the given lookup, else nothing; the optional package is stood in for."""
    import sys
    import types

    drawn = []
    chem, draw = types.ModuleType("rdkit.Chem"), types.ModuleType("rdkit.Chem.Draw")
    chem.MolFromSmiles = lambda s: f"mol {s}" if set(s) <= set("CO=1c") else None

    class Picture:
        def __init__(self, mol, size):
            drawn.append((mol, size))

        def save(self, out, kind):
            out.write(kind.encode())

    draw.MolToImage = Picture
    chem.Draw = draw
    package = types.ModuleType("rdkit")
    package.Chem = chem
    for name, module in (("rdkit", package), ("rdkit.Chem", chem), ("rdkit.Chem.Draw", draw)):
        monkeypatch.setitem(sys.modules, name, module)
    known = {"ethanol": "CCO", "nonsense": "???"}.get
    assert providers.draw_molecule("C=O") == providers.draw_molecule("ethanol", known) == b"PNG"
    assert providers.draw_molecule("nonsense", known) is None and providers.draw_molecule("unknown", known) is None and providers.draw_molecule("ethanol") is None
    assert drawn == [("mol C=O", (300, 300)), ("mol CCO", (300, 300))]


def test_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "exam.txt").write_text(" Hi {x} \n")
    (tmp_path / "q.json").write_text('[{"question": "a"}, "b"]')
    (tmp_path / "no.json").write_text('{"question": "a"}')
    assert [tuple(r) for r in files.templates(spark, f"{tmp_path}/t").collect()][0][0] == "exam.txt"
    assert [r.question for r in files.sample_questions(spark, f"{tmp_path}/q.json").orderBy("pos").collect()] == ["a", "b"]
    assert files.sample_questions(spark, f"{tmp_path}/no.json").count() == 0
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.pdf").write_bytes(b"one\x0ctwo")
    (tmp_path / "d" / "b.pdf").write_bytes(b"bad")

    def reader(content):
        if content == b"bad":
            raise ValueError
        return content.decode().split("\x0c")

    assert [r.text for r in files.binary_pages(spark, f"{tmp_path}/d", reader).orderBy("page_number").collect()] == ["one", "two"]
    (tmp_path / "d" / "b.pdf").unlink()
    (tmp_path / "d" / "c.TXT").write_bytes(b"x")
    with pytest.raises(Exception, match="no reader"):
        files.question_files(spark, f"{tmp_path}/d", pages=reader).collect()
    images = bank.image_rows(spark.createDataFrame([("7", base64.b64encode(b"png").decode()), ("8", None)], "id string, p string"), "id", F.col("p"))
    bank.write_images(images, f"{tmp_path}/img")
    assert (tmp_path / "img" / "diagram_7.png").read_bytes() == b"png"
    assert [r.id for r in files.output_ids(spark, f"{tmp_path}/img").collect()] == ["7"]


def test_config(spark, tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text('{"database": {}, "prompts": {}, "pdf": {}, "task": {"name": "AP Calculus BC"}}')
    assert config.task_config(spark, f"{tmp_path}/c.json").collect()[0].subject == "calculus"
    (tmp_path / "e.json").write_text('{"database": {}}')
    with pytest.raises(Exception, match="lacks"):
        config.task_config(spark, f"{tmp_path}/e.json").collect()
    monkeypatch.setenv("QUIZ_HOST", "h")
    assert config.environment({"QUIZ_HOST": "x", "QUIZ_PORT": "1"}) == {"QUIZ_HOST": "h", "QUIZ_PORT": "1"}


def test_bank_tables(spark, tmp_path):
    path = f"{tmp_path}/bank"
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert bank.table_or_empty(spark, path, rows.schema).count() == 0
    assert bank.append_new(rows, path, "k") == 2 and bank.append_new(rows, path, "k") == 0
    with pytest.raises(ValueError):
        bank.write_output(rows, "elsewhere", path)
    bank.write_output(rows, "file", f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 3
    state = SeenState(spark, f"{tmp_path}/state", "v", buckets=4)
    state.add(rows)
    assert sorted(map(tuple, state.in_order().collect())) == [("a", 0), ("b", 1)]
    bank.write_texts(rows, F.concat("v", F.lit(" /x")), F.col("v"), f"{tmp_path}/texts")
    assert (tmp_path / "texts" / "name=a__x").is_dir()


def test_streams(spark, tmp_path):
    source = f"{tmp_path}/in"
    rows = [(i, f"Q  {i % 3}", f"2024-01-01 00:00:{i:02d}") for i in range(9)]
    df = spark.createDataFrame(rows, "id int, question string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    for name, out in (("unique", unique_questions(stream, "question", "at")), ("counts", windowed_counts(stream, "at", "question"))):
        q = out.writeStream.format("memory").queryName(name).outputMode("append" if name == "unique" else "complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp-{name}").start()
        q.awaitTermination(120)
    assert spark.table("unique").count() == 3 and spark.table("counts").agg(F.sum("n")).first()[0] == 9
    write = sync_batches(f"{tmp_path}/synced", "id")
    write(df, 0)
    write(df, 0)
    assert spark.read.parquet(f"{tmp_path}/synced").count() == 9


def test_jobs(spark, tmp_path):
    from quizloom.__main__ import arguments, run

    rows = spark.createDataFrame([(str(i), f"Q{i % 3}", [f"{c}. {c}" for c in "ABCD"], "A") for i in range(6)], "_id string, question string, multiple_choices array<string>, correct_answer string")
    rows.write.parquet(f"{tmp_path}/src")
    rows.where("_id < '2'").write.parquet(f"{tmp_path}/dst")
    call = lambda *a: run(spark, arguments([str(x) for x in a]))
    side = ("--source", f"{tmp_path}/src", "--target", f"{tmp_path}/dst", "--id-field", "_id")
    assert call("sync", *side, "--dry-run") == {"added_count": 4, "deleted_count": 0, "changed_count": 0, "synced_count": 0}
    assert call("sync", *side)["synced_count"] == 4 and call("sync", *side)["synced_count"] == 0
    assert call("shuffle", "--bank", f"{tmp_path}/src", "--out", f"{tmp_path}/new", "--seed", "s") == {"rows": 6}
    assert call("dedup", "--bank", f"{tmp_path}/src", "--out", f"{tmp_path}/u1", "--seen", f"{tmp_path}/seen", "--version", 1) == {"rows": 3}
    assert call("dedup", "--bank", f"{tmp_path}/src", "--out", f"{tmp_path}/u2", "--seen", f"{tmp_path}/seen", "--version", 2) == {"rows": 0}
    assert call("dedup", "--bank", f"{tmp_path}/src", "--out", f"{tmp_path}/u3", "--seen", f"{tmp_path}/seen") == {"rows": 0}  # the run without rows has lost nothing


def test_answer_key_tables(spark, tmp_path):
    (tmp_path / "k.pdf").write_bytes(b"x")
    reader = lambda content: [("Answer Key", [["no", "a", "s", "l", "u"], ["1", "B", "s", "l", "2"]]), ("other", [["h"], ["9"]])]
    assert [r.cells for r in files.binary_tables(spark, f"{tmp_path}/k.pdf", reader).collect()] == [["1", "B", "s", "l", "2"]]


def test_skill_resolution(spark):
    from quizloom.operators.lookup import resolve_skills

    skills, tasks = spark.createDataFrame([(1, "L"), (2, "S")], "skill_id long, skill_name string"), spark.createDataFrame([(1, "T1"), (2, "T1")], "skill_id long, task_name string")
    assert [r.skill_id for r in resolve_skills(spark, skills, tasks, [2], "T1").collect()] == [2]
    assert resolve_skills(spark, skills, tasks, [], "T1").count() == 2
    with pytest.raises(ValueError):
        resolve_skills(spark, skills, tasks)


def test_long_responses_are_spread(spark, units, monkeypatch):
    """The few responses of an exam, as long as it has questions, are read by all tasks."""
    parts, read = [], workflows.bank.questions_of
    monkeypatch.setattr(workflows.bank, "questions_of", lambda rows, *rest: parts.append(rows.rdd.getNumPartitions()) or read(rows, *rest))
    assert workflows.exam(spark, units, "Maths", 10, "2024-01-02 03:04:05").count() == 9
    assert set(parts) == {spark.sparkContext.defaultParallelism}
