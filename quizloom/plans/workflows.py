"""End-to-end flows. Model calls happen between two written tables, never inside a plan that may run again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions import choices, jsonfix, prompts, text
from quizloom.functions.once import with_once
from quizloom.operators import bank, dedup, delta, framework, lookup, pages, summary
from quizloom.sources import providers
from quizloom.sources.bank import upsert
from quizloom.sources.journal import Journal
from quizloom.sources.seen import SeenState
from quizloom.tables import Tables

EXAM_SYSTEM = "You write exam questions for {subject}."
EXAM_USER = "Write {n_questions} questions on the unit {unit} of {subject}.\n{objectives}"
SKILL_USER = "Write {n_questions} questions at level {level} on the skill {skill}.\n{objectives}{samples}"
ENHANCE_USER = "Check and improve this question on {skill}, level {level}:\n{question}\nOptions: {multiple_choices}\nAnswer: {correct_answer}"
SHEET_USER = "Summarise the topic {topic} of {subject} on one page.\n{objectives}"
PAGE_USER = "Extract the questions of this page on {topic} (diagram: {diagram}):\n{page}"
READ_IMAGE = "Write down the question that this image asks, then, after a line of dashes, what else it shows."
SIMILAR_USER = "Write {num_questions} questions like this one:\n{sample_question}"


def answered(tables: Tables, rows: DataFrame, tag: str, provider: str, call: providers.Call, settings: dict | None = None, per_row: tuple[str, ...] = (), model: str = "offline", responses: str | None = None, **options) -> DataFrame:
    """The rows with their response; requests and responses are written tables.

    ``responses`` is the path of a journal that outlives the run; ``options`` (connect, tasks) are those of ``providers.respond``.
    """
    asked = tables.save(providers.requests(rows, provider, model=model, settings=settings, per_row=per_row), f"{tag}-requests")
    options |= {"provider": provider, "call": call}
    got = providers.answers(asked, responses, **options) if responses else tables.save(providers.respond(asked, **options), f"{tag}-responses")
    return asked.join(got, "request_id", "left").drop("settings")


QUESTION_FIELDS = {"question": "string", "correct_answer": "string", "level": "string", "level_num": "int", "requires_diagram": "boolean", "multiple_choices": "array<string>"}


def question_columns(q: Column) -> list[Column]:
    parts = [jsonfix.field(q, n) for n in ("question", "stem", "prompt", "title")]
    steps = F.coalesce(jsonfix.field(q, "diagram_gen_steps", "array<string>"), jsonfix.field(q, "diagram_instructions", "array<string>"))
    return [*[jsonfix.field(q, n, k).alias(n) for n, k in QUESTION_FIELDS.items()], steps.alias("diagram_gen_steps"), text.dedup_hash(text.canonical_text(*parts)).alias("hash")]


def exam(spark: SparkSession, units: DataFrame, subject: str, total: int, created_at: str, seen: DataFrame | SeenState | None = None, provider: str = "offline", call: providers.Call = providers.offline, compat: bool = False, **options) -> DataFrame:
    """Questions for each unit (unit_id, unit, weight, objectives) by its weight, unique by hash within the run and against ``seen``.

    Where ``seen`` is the state of earlier runs, the hashes of this one are added to it.
    """
    tables = Tables(spark, "exam")
    planned = tables.save(framework.allocate(units, total), "units")
    params = {"subject": F.lit(subject), "unit": F.col("unit"), "n_questions": F.col("num_questions"), "objectives": prompts.user_objectives(F.col("objectives"))}

    def produce(short: DataFrame, attempt: int) -> DataFrame:
        rows = short.select("unit_id", F.col("deficit").alias("num_questions")).join(planned, "unit_id")
        rows = rows.withColumn("system_prompt", prompts.render(EXAM_SYSTEM, params)).withColumn("user_prompt", prompts.with_constraints(prompts.render(EXAM_USER, params), F.lit(f"{created_at}_{attempt}")))
        got = answered(tables, rows.select("unit_id", "num_questions", "system_prompt", "user_prompt"), f"call-{attempt}", provider, call, per_row=("num_questions",), **options)
        answers = got.select("unit_id", "response").repartition(spark.sparkContext.defaultParallelism)  # few and long: by size, one task would read them all
        found = bank.questions_of(answers, "response").select("unit_id", "pos", *question_columns(F.col("q")))
        if isinstance(seen, SeenState):
            return seen.unseen(tables.save(found, f"found-{attempt}"))
        return found if seen is None else dedup.unseen(found, seen, "hash")

    wanted = planned.select("unit_id", F.col("n_questions").alias("want"))
    rows = dedup.fill(wanted, produce, "unit_id", "hash", "pos", tables.save, compat=compat)
    if isinstance(seen, SeenState):
        rows = tables.save(rows, "rows")
        seen.add(rows)
    order = F.row_number().over(dedup.Window.partitionBy("unit_id").orderBy("attempt", "pos")) - 1
    return bank.enrich(rows.withColumn("place", order), "place", "unit_id", F.lit(created_at).cast("timestamp"))


def skill_levels(spark: SparkSession, skills: DataFrame, levels: dict[str, int], n_questions: int, samples: Column | None = None, provider: str = "offline", call: providers.Call = providers.offline, templates: Mapping[str, tuple[str, str]] | DataFrame | None = None, created_at: str | None = None, out: str | None = None, **options) -> DataFrame:
    """Questions for each skill (skill_id, skill, objectives) at each level.

    ``templates`` has the system and user template of each level: a mapping, where a level without is an error before anything runs, or rows (level, system, user), where
    it is one as the query runs. With ``out``, the questions, with created_at, are also appended to the table there.
    """
    tables = Tables(spark, "skills")
    if not isinstance(templates, DataFrame):
        pairs = templates or dict.fromkeys(levels, ("You write questions at a given level.", SKILL_USER))
        if lacking := set(levels) - set(pairs):
            raise ValueError(f"no template for {sorted(lacking)}")
        templates = spark.createDataFrame([(k, *pairs[k]) for k in levels], "level string, system string, user string")
    rows = lookup.with_template(lookup.with_levels(skills, levels), templates.select("level", "system", "user"))
    params = {"n_questions": F.lit(n_questions), "level": F.col("level"), "level_num": F.col("level_num"), "skill": F.col("skill"), "objectives": prompts.objectives_section(F.col("objectives")), "samples": F.lit("") if samples is None else prompts.sample_section(samples)}
    filled = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), v.cast("string"))])
    rows = rows.withColumns({"system_prompt": prompts.render_rows(F.col("system"), filled), "user_prompt": prompts.render_rows(F.col("user"), filled)})
    got = answered(tables, rows.select("skill_id", "skill", "level", "level_num", "system_prompt", "user_prompt"), "call", provider, call, {"num_questions": n_questions}, **options)
    found = bank.questions_of(got.select("skill_id", "skill", F.col("level").alias("asked_level"), "response"), "response", jsonfix.sanitize_bank)
    made = found.select("skill_id", "skill", "asked_level", "pos", *question_columns(F.col("q")))
    if created_at is not None:
        made = made.withColumn("created_at", F.lit(created_at).cast("timestamp"))
    if out is None:
        return made
    made = tables.save(made, "questions")
    made.write.mode("append").parquet(out)
    return made


# What an enhancement prompt may name, with what stands for a missing value
ENHANCE_DEFAULTS = {
    "subject": "", "subject_id": None, "subject_area": "", "subject_area_id": None, "question": "", "skill": "", "skill_name": "", "skill_id": None, "multiple_choices": "[]", "correct_answer": "",
    "level": "", "level_num": 0, "requires_diagram": False, "learning_objectives": "[]", "skill_topic": "", "bloom_levels": "[]",
}


def enhance_params(rows: DataFrame) -> dict[str, Column]:
    """The parameters of an enhancement prompt: columns of these names, lists as JSON; ``None`` where an id is missing."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def value(name: str, default: object) -> Column:
        own = F.to_json(name) if kinds.get(name, "").startswith("array") else F.col(name).cast("string") if name in kinds else F.lit(None).cast("string")
        return F.coalesce(own, F.lit(str(default)))

    return {name: value(name, default) for name, default in ENHANCE_DEFAULTS.items()}


def enhance(spark: SparkSession, questions: DataFrame, skills: DataFrame, provider: str = "offline", call: providers.Call = providers.offline, system: str = "You review questions.", user: str = ENHANCE_USER, **options) -> DataFrame:
    """Each question of a known skill with the model's answer to it as JSON; questions without skill drop out.

    The templates may name the sixteen parameters of ``enhance_params``; columns of ``skills`` are there too.
    """
    tables = Tables(spark, "enhance")
    new = [c for c in skills.columns if c == "skill_id" or c not in questions.columns or c == "skill"]
    rows = questions.drop("skill").join(skills.select(new), "skill_id")
    params = enhance_params(rows)
    rows = rows.withColumn("system_prompt", prompts.render(system, params)).withColumn("user_prompt", prompts.render(user, params))
    got = answered(tables, rows, "call", provider, call, **options)
    return got.withColumn("enhanced", F.to_json(jsonfix.parse(jsonfix.sanitize_bank(F.col("response"))))).drop("response", "system_prompt", "user_prompt")


def cheat_sheets(spark: SparkSession, topics: DataFrame, provider: str = "offline", call: providers.Call = providers.offline, model: str = "offline", created_at: str | None = None, out: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(sheets, summary) for each (subject, topic, objectives): a failure of one topic leaves the others alone, and no model is asked for a topic that has failed before.

    With ``out``, the sheets that came are also appended to the table there as documents (``sheet_documents``).
    """
    tables = Tables(spark, "sheets")
    params = {"topic": F.col("topic"), "subject": F.col("subject"), "objectives": prompts.user_objectives(F.col("objectives"))}
    rows = topics.withColumn("system_prompt", F.concat(F.lit("You write cheat sheets."), prompts.system_objectives(F.col("objectives")))).withColumn("user_prompt", prompts.render(SHEET_USER, params))
    before = [("framework", F.size("objectives") > 0), ("prompts", F.col("user_prompt").isNotNull())]
    rows = tables.save(summary.chain(rows, before), "prompts")
    got = answered(tables, rows.where("success").drop("error", "success"), "call", provider, call, {"temperature": 0.1}, model=model, **options)
    rest = rows.where("NOT success").drop("error", "success").withColumn("response", F.lit(None).cast("string"))
    done = summary.chain(got.drop("request_id").unionByName(rest), [*before, ("model", F.col("response").isNotNull())])
    answer = jsonfix.strip_fences(F.col("response"))
    done = done.select("subject", "topic", F.size("objectives").alias("objectives_count"), "success", "error", F.when(F.col("success"), jsonfix.unwrap(answer)).alias("cheat_sheet"), F.when(F.col("success"), jsonfix.whole(answer)).alias("file_body"))
    done = tables.save(done, "sheets")
    if out is not None:
        sheet_documents(done.where("success"), provider, model, F.lit(created_at).cast("timestamp")).write.mode("append").parquet(out)
    return done, summary.summarise(done, "subject")


def sheet_documents(sheets: DataFrame, provider: str, model: str, created_at: Column) -> DataFrame:
    """content_type, cheat_sheet, provider, model, created_at and metadata of each sheet."""
    meta = F.struct("subject", "topic", "objectives_count")
    return sheets.select(F.lit("cheat_sheet").alias("content_type"), "cheat_sheet", F.lit(provider).alias("provider"), F.lit(model).alias("model"), created_at.alias("created_at"), meta.alias("metadata"))


def extract(spark: SparkSession, page_rows: DataFrame, key_rows: DataFrame, topic: str, provider: str = "offline", call: providers.Call = providers.offline, out: str | None = None, **options) -> DataFrame:
    """Questions with metadata and vectors from pages (doc, page_number, text) and answer-key rows.

    With ``out``, they also take the place of those with their ids in the keyed table there; a page read again replaces its questions.
    """
    tables = Tables(spark, "extract")
    flagged = pages.page_flags(page_rows)
    aligned = pages.align(flagged, pages.answer_key(key_rows))
    filled = pages.carry_forward(aligned, ["question_number", "answer", "skill", "learning_objective", "unit"], F.trim("text") != "", "doc", "page_number")
    params = {"topic": F.lit(topic), "diagram": F.col("diagram_required"), "page": F.coalesce("text", F.lit(""))}
    rows = filled.withColumn("system_prompt", F.lit("You extract questions.")).withColumn("user_prompt", prompts.render(PAGE_USER, params))
    got = answered(tables, rows, "call", provider, call, **options)
    keep = [c for c in filled.columns if c != "text"]
    found = bank.questions_of(got.select(*keep, "response"), "response").select(*keep, "pos", jsonfix.field(F.col("q"), "question").alias("question"))
    found = tables.save(found.withColumn("question_id", F.sha2(F.concat_ws("|", "doc", F.col("page_number").cast("string"), F.col("pos").cast("string")), 256)), "questions")
    made = found.join(providers.embed(found, "question_id", "question"), "question_id")
    return made if out is None else upsert(made, out, "question_id").read().join(found.select("question_id"), "question_id", "left_semi")


def similar(spark: SparkSession, samples: DataFrame, n: int, provider: str = "offline", call: providers.Call = providers.offline, model: str = "offline", system: str = "You vary questions.", user: str = SIMILAR_USER, **options) -> DataFrame:
    """n questions like each sample (doc, text); an unreadable answer stays as raw_output.

    The templates may name model, num_questions, sample_question and every other column of ``samples``.
    """
    tables = Tables(spark, "similar")
    params = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in samples.columns} | {"model": F.lit(model), "num_questions": F.lit(n), "sample_question": F.trim("text")}
    rows = samples.withColumn("system_prompt", prompts.render(system, params)).withColumn("user_prompt", prompts.render(user, params))
    got = answered(tables, rows, "call", provider, call, {"num_questions": n}, model=model, **options)
    v = jsonfix.parse(jsonfix.strip_fences(F.col("response")))
    return got.select("doc", F.to_json(v).alias("questions"), F.when(v.isNull(), F.col("response")).alias("raw_output"))


def image_questions(spark: SparkSession, images: DataFrame, key: str, content: str, prompt: str = READ_IMAGE, provider: str = "offline", call=providers.offline_reading, model: str = "offline", responses: str | None = None, per_batch: int = 100, **options) -> DataFrame:
    """key, question, details of each image: what a model reads from its bytes, parted at a line of dashes. Equal images are read once; those without content or answer have nulls.

    ``responses`` is the path of a journal that outlives the run, ``options`` (connect, tasks) are those of ``providers.read_images``.
    """
    tables = Tables(spark, "readings")
    asked = tables.save(providers.image_requests(images.select(key, content), content, prompt, provider, model), "requests")
    options |= {"content": content, "prompt": prompt, "provider": provider, "call": call}
    if responses:
        got = Journal(spark, responses, "request_id string, response string").run(asked.select("request_id", content), lambda rows, parts: providers.read_images(rows, **options | {"tasks": parts}), per_batch, options.get("tasks"))
    else:
        got = tables.save(providers.read_images(asked, **options), "responses")
    read = asked.select(key, "request_id").join(got, "request_id").select(key, jsonfix.image_text(F.col("response")).alias("r"), F.col("response").isNotNull().alias("ok"))
    read = read.where("ok").select(key, "r.question", "r.details").dropDuplicates([key])
    return images.select(key).join(read, key, "left")


def diagrams(questions: DataFrame, done: DataFrame, key: str, draw, **filters: str | None) -> DataFrame:
    """PNG for each question that needs a diagram and has none yet."""
    found = lookup.pending(lookup.diagram_candidates(questions, F.col("requires_diagram"), **filters), done, key)
    prompt = prompts.diagram_prompt(text.first_truthy(F.col("question_text"), F.col("question")), F.array_join("diagram_gen_steps", " "))
    return providers.images(found.withColumn("prompt", prompt), key, "prompt", draw)


def sync(source: DataFrame, target: DataFrame, key: str, dry_run: bool = False, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(target after the sync, added / deleted / changed counts). Of repeated keys the last row by ``order`` is compared."""
    sides = [d.select(key, *([order] if order else []), text.document_hash([c for c in d.columns if c != order]).alias("hash")) for d in (source, target)]
    return delta.apply_added(source, target, key, dry_run), delta.stats(delta.classify(*sides, key, "hash", order))


def shuffle_bank(questions: DataFrame, key: str, seed: str) -> DataFrame:
    """The bank with shuffled options where the answer's letter moved; other rows, and those without labels, as they were."""
    moved = choices.shuffled(F.col("multiple_choices"), F.col("correct_answer"), F.col(key), seed)
    new = with_once(questions, "m", moved, lambda m: m["answer"] != F.col("correct_answer")).select(key, "m")
    return delta.merge_changes(questions, new.select(key, F.col("m.choices").alias("multiple_choices"), F.col("m.answer").alias("correct_answer")), key, ["multiple_choices", "correct_answer"])
