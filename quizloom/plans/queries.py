"""One query for each operator on the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions import choices, jsonfix, prompts, text
from quizloom.functions.once import with_once
from quizloom.operators import bank, contracts, dedup, delta, framework, lookup, pages, summary
from quizloom.sources import bank as bank_tables
from quizloom.sources import files, paged, providers
from quizloom.sources.seen import SeenState
from quizloom.sources.sinks import Delivery, Sink
from quizloom.sources.store import Store
from quizloom.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
BATCH_TIME = "2024-01-02 03:04:05"
SHUFFLE_SEED = "choices-1"
#: Buckets of the tables that queries make.
BUCKETS = 8


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for a query that writes, which goes when the session ends."""
    tables = Tables(spark, name)
    tables.save(spark.range(1), "made")
    return tables.path


# --- lookups -----------------------------------------------------------------------------------------------------

ASKED = [7, 3, 3, 10**9, 11, 1]


@query(f"""
WITH asked AS (SELECT unnest({list(range(len(ASKED)))}) AS pos, unnest({ASKED}) AS c_custkey),
task AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1)
SELECT pos, c.c_custkey, c_name AS skill_name, o_orderkey FROM asked JOIN customer c USING (c_custkey) LEFT JOIN task ON o_custkey = c_custkey""")
def skill_lookup_by_ids(spark, d):
    tasks = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    out = lookup.lookup_ids(spark, ASKED, read(spark, d, "customer").select("c_custkey", "c_name"), tasks, "c_custkey", "o_orderkey")
    return out.select("pos", "c_custkey", F.col("c_name").alias("skill_name"), "o_orderkey")


@query("""SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = (SELECT min(n_name) FROM nation)""")
def skills_by_task_name(spark, d):
    nation = read(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    name = nation.agg(F.min("n_name")).first()[0]
    return lookup.by_task(read(spark, d, "customer"), nation, "c_nationkey", F.col("n_name") == name).select("c_custkey", "c_name", "n_name")


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 25")
def find_by_field_limit(spark, d):
    return lookup.find(read(spark, d, "documents").select("doc_id", "lang", "source"), [("source", None), ("lang", "de")], 25, ["doc_id"])


@query("""SELECT 'src1' AS asked, doc_id, source FROM documents WHERE source = 'src1' UNION ALL SELECT 'all', doc_id, source FROM documents""")
def scan_optional_subject(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "source")
    one = lookup.find(docs, [("source", "src1")]).select(F.lit("src1").alias("asked"), "*")
    return one.unionByName(lookup.find(docs, [("source", None)]).select(F.lit("all").alias("asked"), "*"))


@query("SELECT r_regionkey, r_name FROM region WHERE r_name LIKE '%A%' ORDER BY r_regionkey LIMIT 1")
def framework_first_match(spark, d):
    return lookup.first_match(read(spark, d, "region"), F.contains("r_name", F.lit("A")), "r_regionkey").select("r_regionkey", "r_name")


@query("SELECT DISTINCT source FROM documents")
def distinct_subjects(spark, d):
    return read(spark, d, "documents").select("source").distinct()


@query("SELECT count(*) AS n_rows, count(DISTINCT source) AS n_subjects, min(source) AS first_subject FROM documents")
def collection_stats(spark, d):
    return framework.collection_stats(read(spark, d, "documents"), "source")


@query("""SELECT doc_id, lower(md5(CAST(doc_id AS VARCHAR)))[1:24] AS _id FROM documents WHERE lower(md5(CAST(doc_id AS VARCHAR)))[1:24] = md5('17')[1:24]""")
def lookup_by_object_id(spark, d):
    import hashlib

    rows = read(spark, d, "documents").select("doc_id", F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 24).alias("_id"))
    return lookup.by_object_id(rows, hashlib.md5(b"17").hexdigest()[:24])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def fetch_many(spark, d):
    keys = read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return lookup.fetch(read(spark, d, "orders").select("o_orderkey", "o_custkey"), keys, "o_custkey")


# --- frameworks --------------------------------------------------------------------------------------------------


#: Customers of a framework at most: a framework is a document of bounded size.
BLOCK = 1000


def course_frameworks(spark, d, objectives=None):
    """Region, nation, segment, customer as subject, unit, topic, objective; a framework for each nation and BLOCK customer keys."""
    block = F.floor(F.col("c_custkey") / BLOCK).alias("block")
    customer = read(spark, d, "customer").select("c_nationkey", block, "c_mktsegment", "c_custkey", (F.to_json(F.struct(F.col("c_name").alias("description"))) if objectives is None else objectives).alias("o"))
    topic = customer.groupBy("c_nationkey", "block", "c_mktsegment").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "o"))).alias("os"))
    topic = topic.select("c_nationkey", "block", F.struct(F.col("c_mktsegment").alias("topic"), F.transform("os", lambda s: F.parse_json(s["o"])).alias("objectives")).alias("t"))
    unit = topic.groupBy("c_nationkey", "block").agg(F.collect_list("t").alias("ts"))
    order = lambda a, b: F.when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)
    unit = unit.withColumn("ts", F.array_sort("ts", order)).join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    unit = unit.select("n_regionkey", "n_name", "block", F.array(F.struct(F.col("n_name").alias("unit"), F.col("ts").alias("topics"))).alias("units"))
    frame = unit.join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return frame.select(F.struct("r_regionkey", "n_name", "block").alias("ord"), F.col("r_name").alias("subject"), "units")


@query(f"""
WITH c AS (SELECT c_custkey // {BLOCK} AS block, * FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_name = (SELECT min(n_name) FROM nation))
SELECT block, CAST(dense_rank() OVER (PARTITION BY block ORDER BY c_mktsegment) - 1 AS INT) AS topic_pos, CAST(row_number() OVER (PARTITION BY block, c_mktsegment ORDER BY c_custkey) - 1 AS INT) AS objective_pos, c_name AS objective FROM c""")
def unwind_unit_objectives(spark, d):
    nation = read(spark, d, "nation")
    unit = nation.orderBy("n_name").limit(1).join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).first()
    return framework.unit_objectives(course_frameworks(spark, d), unit.r_name, unit.n_name).select(F.col("framework_ord.block").alias("block"), "topic_pos", "objective_pos", "objective")


@query(f"""
SELECT c_custkey // {BLOCK} AS block, n_name AS unit, coalesce(string_agg(CASE WHEN c_custkey % 3 <> 2 THEN c_name END, '|' ORDER BY c_mktsegment, c_custkey), '') AS objectives
FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def polymorphic_objectives(spark, d):
    kind = F.col("c_custkey") % 3
    objective = F.when(kind == 0, F.to_json(F.struct(F.col("c_name").alias("description")))).when(kind == 1, F.concat(F.lit('"'), "c_name", F.lit('"'))).otherwise(F.lit('{"description":""}'))
    units = course_frameworks(spark, d, objective).select("ord.block", F.explode("units").alias("u"))
    return units.select("block", "u.unit", F.array_join(framework.flat_objectives(F.col("u.topics")), "|").alias("objectives"))


@query("""
WITH o AS (SELECT o_custkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) - 1 AS topic_pos, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) - 1 AS objective_pos, 'order ' || o_orderkey AS objective
           FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT c_custkey, CAST(topic_pos AS INT) AS topic_pos, CAST(objective_pos AS INT) AS objective_pos, objective FROM customer LEFT JOIN o ON o_custkey = c_custkey""")
def objectives_of_skills(spark, d):
    """A framework a customer: priorities are units, states topics, orders objectives; every customer asks for one unit."""
    topic = read(spark, d, "orders").groupBy("o_custkey", "o_orderpriority", "o_orderstatus").agg(F.array_sort(F.collect_list("o_orderkey")).alias("os"))
    objectives = F.transform("os", lambda o: F.parse_json(F.to_json(F.struct(F.concat(F.lit("order "), o.cast("string")).alias("description")))))
    topic = topic.select("o_custkey", "o_orderpriority", F.col("o_orderstatus").alias("s"), objectives.alias("objectives"))
    by_name = lambda a, b: F.when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)
    unit = topic.groupBy("o_custkey", "o_orderpriority").agg(F.array_sort(F.collect_list(F.struct(F.col("s").alias("topic"), "objectives")), by_name).alias("topics"))
    frames = unit.groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderpriority").alias("unit"), "topics")).alias("units")).select(F.col("o_custkey").alias("subject"), F.lit(0).alias("ord"), "units")
    asked = read(spark, d, "customer").select("c_custkey", F.lit("1-URGENT").alias("skill"))
    return framework.objectives_for(asked, frames, "c_custkey", "skill").select("c_custkey", "topic_pos", "objective_pos", "objective")


@query("""
WITH w AS (SELECT c_nationkey, count(*) AS weight FROM customer GROUP BY 1)
SELECT c_nationkey AS unit, weight, CAST(ceil(weight * 44 / 100.0) AS BIGINT) AS n_questions FROM w WHERE weight > 0""")
def weighted_allocation(spark, d):
    weights = read(spark, d, "customer").groupBy(F.col("c_nationkey").alias("unit")).agg(F.count("*").alias("weight"))
    return framework.allocate(weights, 44)


@query("SELECT r_name AS subject, n_name AS unit FROM region JOIN nation ON n_regionkey = r_regionkey WHERE lower(n_name) = lower((SELECT max(n_name) FROM nation))")
def unit_filter_ci(spark, d):
    nation = read(spark, d, "nation")
    name = nation.agg(F.max("n_name")).first()[0].swapcase()
    units = nation.groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_name").alias("unit"))).alias("units"))
    found = units.select("n_regionkey", F.explode(framework.find_unit(F.col("units"), name)).alias("u"))
    return found.join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("subject"), F.col("u.unit").alias("unit"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 4 <> 0 AND n_nationkey % 5 <> 0")
def topics_non_empty(spark, d):
    name = F.when(F.col("n_nationkey") % 4 == 0, F.lit("")).when(F.col("n_nationkey") % 5 != 0, F.col("n_name"))
    rows = read(spark, d, "nation").select("n_nationkey", name.alias("n_name"))
    return rows.where("n_name IS NOT NULL AND n_name <> ''")


@query(f"""
SELECT r_name AS subject, n_name AS unit, c_mktsegment AS topic, c_name AS objective FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
WHERE r_regionkey = (SELECT min(r_regionkey) FROM region) ORDER BY n_name, c_custkey // {BLOCK}, c_mktsegment, c_custkey LIMIT 1""")
def sample_document(spark, d):
    return framework.sample_path(course_frameworks(spark, d))


# --- de-duplication ----------------------------------------------------------------------------------------------


def hashed_documents(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "lang", "text")
    return with_once(rows, "hash", text.dedup_hash(text.canonical_text(F.col("text")))).drop("text")


HASHED = r"(SELECT doc_id, lang, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS hash FROM documents WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> '')"


@query(f"SELECT doc_id, hash FROM {HASHED}")
def canonical_hash(spark, d):
    return hashed_documents(spark, d).where("hash IS NOT NULL").select("doc_id", "hash")


@query(f"SELECT hash, min(doc_id) AS doc_id FROM {HASHED} GROUP BY hash")
def dedup_in_batch(spark, d):
    return dedup.first_seen(hashed_documents(spark, d).select("doc_id", "hash"), "hash", "doc_id")


@query(f"""
WITH new AS (SELECT hash, min(doc_id) AS doc_id FROM {HASHED} WHERE doc_id % 2 = 1 GROUP BY hash)
SELECT doc_id, hash FROM new WHERE hash NOT IN (SELECT hash FROM {HASHED} WHERE doc_id % 2 = 0)""")
def dedup_cross_run(spark, d):
    """The even documents are the state of an earlier run; the odd ones pass its filter, then its exact anti join."""
    rows = hashed_documents(spark, d).select("doc_id", "hash")
    state = SeenState(spark, f"{folder(spark, 'seen')}/state", buckets=BUCKETS)
    state.add(rows.where("doc_id % 2 = 0"))
    return state.unseen(dedup.first_seen(rows.where("doc_id % 2 = 1"), "hash", "doc_id")).select("doc_id", "hash")


@query(f"SELECT DISTINCT hash FROM {HASHED}")
def seen_state(spark, d):
    """What two runs have left in the state."""
    rows = hashed_documents(spark, d)
    state = SeenState(spark, f"{folder(spark, 'seen')}/state", buckets=BUCKETS)
    for odd in (0, 1):
        state.add(rows.where(f"doc_id % 2 = {odd}"))
    return state.read()


@query(f"""
WITH u AS (SELECT lang, count(DISTINCT hash) AS have FROM {HASHED} GROUP BY lang), w AS (SELECT lang, count(*) AS want FROM documents GROUP BY lang)
SELECT lang, want, coalesce(have, 0) AS have, greatest(0, want - coalesce(have, 0)) AS deficit FROM w LEFT JOIN u USING (lang)""")
def retry_deficit(spark, d):
    rows = hashed_documents(spark, d)
    wanted = rows.groupBy("lang").agg(F.count("*").alias("want"))
    return dedup.deficits(wanted, rows.where("hash IS NOT NULL").select("lang", "hash").distinct(), "lang")


@query(f"""
WITH u AS (SELECT hash, min({{'d': doc_id, 'l': lang}}) AS m FROM {HASHED} GROUP BY hash)
SELECT m.d AS doc_id, m.l AS lang, hash FROM u QUALIFY row_number() OVER (PARTITION BY m.l ORDER BY m.d) <= 10""")
def trim_to_wanted(spark, d):
    unique = dedup.first_seen(hashed_documents(spark, d), "hash", "doc_id", "lang").withColumn("want", F.lit(10))
    return dedup.trim(unique, ["lang"], "want", "doc_id").drop("want")


@query("SELECT conv_id, turn, CAST(turn + 1 AS BIGINT) AS question_index, conv_id AS set_index, 'batch_20240102_030405' AS batch_id, 'tests' AS question_type FROM conversations")
def enrich_metadata(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", "turn")
    return bank.enrich(rows, "turn", "conv_id", F.lit(BATCH_TIME).cast("timestamp")).drop("created_at")


# --- pages -------------------------------------------------------------------------------------------------------

PAGE_TEXT_SQL = """CASE l_linenumber % 5 WHEN 0 THEN '' WHEN 1 THEN 'Question ' || l_orderkey || ' see Figure ' || l_partkey WHEN 2 THEN 'FAQ ' || l_suppkey || ' in fig ' || l_partkey
 WHEN 3 THEN 'the Answer Key ' || l_orderkey ELSE 'config GRAPH  ' || l_partkey END"""


def page_rows(spark, d):
    n, key, part, supp = (F.col(c).cast("string") for c in ("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"))
    kind = F.col("l_linenumber") % 5
    body = F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("Question "), key, F.lit(" see Figure "), part)).when(kind == 2, F.concat(F.lit("FAQ "), supp, F.lit(" in fig "), part))
    body = body.when(kind == 3, F.concat(F.lit("the Answer Key "), key)).otherwise(F.concat(F.lit("config GRAPH  "), part))
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), "l_partkey", "l_suppkey", body.alias("text"), n.alias("n"))


@query(f"""
WITH p AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_partkey, l_suppkey, {PAGE_TEXT_SQL} AS text FROM lineitem)
SELECT doc, page, l_partkey, l_suppkey, regexp_matches(text, '(?i)(?:figure|fig\\.|diagram|chart|graph|image)\\s+\\d+') AS diagram_required,
 TRY_CAST(nullif(regexp_extract(text, '(?i)(?:Question|Q)\\s*(\\d+)', 1), '') AS INT) AS question_number
FROM p WHERE NOT (contains(text, 'Answer Key') OR contains(text, 'Question Alignment'))""")
def page_flags(spark, d):
    return pages.page_flags(page_rows(spark, d)).drop("text", "n")


def key_rows(spark, d):
    cells = F.split(F.concat_ws(",", F.concat(F.lit(" "), (F.col("o_orderkey") % 97).cast("string"), F.lit(" ")), F.substring("o_orderpriority", 1, 1), "o_orderstatus", F.lit("lo"), F.when(F.col("o_orderkey") % 7 == 0, "3.7").otherwise((F.col("o_orderkey") % 9).cast("string"))), ",")
    n = F.when(F.col("o_orderkey") % 11 == 0, 4).otherwise(5)
    rows = read(spark, d, "orders")
    return rows.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("row_ord"), F.slice(cells, F.lit(1), n).alias("cells"))


KEY_SQL = """(SELECT o_custkey AS doc, CAST(o_orderkey % 97 AS INT) AS question_num, max_by({'a': substr(o_orderpriority, 1, 1), 's': o_orderstatus, 'u': CAST(o_orderkey % 9 AS INT)}, o_orderkey) AS m
 FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 GROUP BY 1, 2)"""


@query(f"SELECT doc, question_num, m.a AS answer, m.s AS skill, 'lo' AS learning_objective, m.u AS unit FROM {KEY_SQL}")
def answer_key_last_wins(spark, d):
    return pages.answer_key(key_rows(spark, d))


@query(f"""
SELECT o_custkey AS doc, o_orderkey AS page, CAST(o_orderkey % 50 AS INT) AS question_number, coalesce(m.a, '') AS answer, coalesce(m.s, '') AS skill,
 CASE WHEN m IS NULL THEN '' ELSE 'lo' END AS learning_objective, m.u AS unit
FROM orders LEFT JOIN {KEY_SQL} k ON k.doc = o_custkey AND k.question_num = o_orderkey % 50 AND o_orderkey % 50 <> 0""")
def page_alignment_join(spark, d):
    rows = read(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("page"), (F.col("o_orderkey") % 50).cast("int").alias("question_number"))
    return pages.align(rows, pages.answer_key(key_rows(spark, d)))


@query(f"""
WITH p AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_partkey, l_suppkey, {PAGE_TEXT_SQL} AS text FROM lineitem),
f AS (SELECT *, TRY_CAST(nullif(regexp_extract(text, '(?i)(?:Question|Q)\\s*(\\d+)', 1), '') AS INT) AS q FROM p WHERE NOT contains(text, 'Answer Key')),
c AS (SELECT *, last_value(CASE WHEN text <> '' THEN {{'q': q}} END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS s FROM f)
SELECT doc, page, l_partkey, l_suppkey, s.q AS question_number FROM c WHERE s IS NOT NULL""")
def page_carry_forward(spark, d):
    rows = pages.page_flags(page_rows(spark, d))
    out = pages.carry_forward(rows, ["question_number"], F.col("text") != "", "doc", "page", "l_partkey", "l_suppkey")
    return out.select("doc", "page", "l_partkey", "l_suppkey", "question_number")


@query("SELECT conv_id, nullif(trim(coalesce(string_agg(CASE WHEN turn % 3 <> 1 THEN text END, chr(10) ORDER BY turn), '')), '') AS full_text FROM conversations GROUP BY conv_id")
def fulltext_concat(spark, d):
    rows = read(spark, d, "conversations").withColumn("text", F.when(F.col("turn") % 3 == 1, "  ").otherwise(F.col("text")))
    return pages.full_text(rows, "conv_id", "turn", "text")


@query(r"""
SELECT p_partkey, 1 AS rec, 'What is ' || p_name || '?' AS question, p_brand AS answer, p_type || '|' || p_brand AS options FROM part
UNION ALL SELECT p_partkey, 2, 'Size?', CAST(p_size AS VARCHAR), NULL FROM part WHERE p_partkey % 2 = 0""")
def labelled_text_parse(spark, d):
    size = F.concat(F.lit("\nquestion of size\nq: Size?\nAnswer: 0\nA: "), F.col("p_size").cast("string"))
    body = F.concat(F.lit("A: lost\nQuestion: What is "), "p_name", F.lit("?\nA: "), "p_brand", F.lit("\nOptions: "), "p_type", F.lit(" , "), "p_brand", F.when(F.col("p_partkey") % 2 == 0, size).otherwise(""))
    out = pages.labelled_text(read(spark, d, "part").select("p_partkey", body.alias("t")), "p_partkey", "t")
    return out.select("p_partkey", F.col("rec").cast("int").alias("rec"), "question", "answer", F.array_join("options", "|").alias("options"))


# --- JSON repair -------------------------------------------------------------------------------------------------


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""")
def fence_strip_parse(spark, d):
    cut = F.when(F.col("event_id") % 4 == 3, F.substring("props", 1, 3)).otherwise(F.col("props"))
    raw = F.concat(F.lit(" ```json"), cut, F.lit("```\n"))
    v = jsonfix.parse(jsonfix.strip_fences(raw))
    return read(spark, d, "events").select("event_id", jsonfix.field(v, "k", "bigint").alias("k"))


# RE2 has no look-behind; two passes give the same for these inputs
LATEX_SQL = r"""'{"q":"' || CASE p_partkey % 4 WHEN 0 THEN '\alpha ' WHEN 1 THEN '\frac{1}{2} ' WHEN 2 THEN '\\theta ' ELSE '\u2019\sum ' END || p_name || '"}'"""


def latex_rows(spark, d):
    kind = F.col("p_partkey") % 4
    part = F.when(kind == 0, "\\alpha ").when(kind == 1, "\\frac{1}{2} ").when(kind == 2, "\\\\theta ").otherwise("\\u2019\\sum ")
    return read(spark, d, "part").select("p_partkey", F.concat(F.lit('{"q":"'), part, "p_name", F.lit('"}')).alias("body"))


def doubled_sql(kept: str) -> str:
    once = rf"""regexp_replace(%s, '(^|[^\\])\\([^{kept}]|$)', '\1\\\\\2', 'g')"""
    return once % (once % f"({LATEX_SQL})")


@query("SELECT p_partkey, " + doubled_sql(r'\\/"bfnrtu') + " AS fixed FROM part")
def sanitize_exam(spark, d):
    return latex_rows(spark, d).select("p_partkey", jsonfix.sanitize_exam(F.concat(F.lit(" ```JSON\n"), "body", F.lit("\n``` "))).alias("f")).select("p_partkey", F.trim(F.regexp_replace("f", r"\n", "")).alias("fixed"))


@query("SELECT p_partkey, " + doubled_sql(r'\\ntr"/') + " AS fixed FROM part")
def sanitize_bank(spark, d):
    return latex_rows(spark, d).select("p_partkey", jsonfix.sanitize_bank(F.concat(F.lit("```json\n"), "body", F.lit("```"))).alias("fixed"))


@query("""
SELECT event_id, CAST(i AS INT) AS pos, CAST(json_extract(props, '$.k') AS BIGINT) + i AS k FROM events, LATERAL (SELECT unnest(range(0, CASE event_type WHEN 'click' THEN 2 ELSE 1 END)) AS i) WHERE event_id % 6 <> 5""")
def root_shape_normalise(spark, d):
    one, k = F.col("props"), F.get_json_object("props", "$.k").cast("bigint")
    two = F.concat(F.lit('{"k": '), (k + 1).cast("string"), F.lit("}"))
    listed = F.concat(F.lit("["), one, F.lit(", "), two, F.lit(", 7]"))
    raw = F.when(F.col("event_id") % 6 == 5, F.lit("7")).when(F.col("event_type") == "click", listed)
    raw = raw.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"questions": ['), one, F.lit("]}"))).otherwise(one)
    rows = read(spark, d, "events").select("event_id", raw.alias("raw"))
    found = bank.questions_of(rows, "raw")
    return found.select("event_id", "pos", jsonfix.field(F.col("q"), "k", "bigint").alias("k"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '{"raw_content":"no json"}' ELSE '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' END AS body FROM events""")
def cheat_sheet_unwrap(spark, d):
    kind = F.col("event_id") % 3
    raw = F.when(kind == 0, F.concat(F.lit('{"cheat_sheet": '), "props", F.lit("}"))).when(kind == 1, F.col("props")).otherwise("no json")
    return read(spark, d, "events").select("event_id", jsonfix.unwrap(raw).alias("body"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'not JSON' ELSE 'no question' END AS reason FROM events WHERE event_id % 3 <> 2""")
def quarantine_responses(spark, d):
    kind = F.col("event_id") % 3
    raw = F.when(kind == 0, "{broken").when(kind == 1, "7").otherwise(F.col("props"))
    return bank.quarantine(read(spark, d, "events").select("event_id", raw.alias("raw")), "raw").select("event_id", "reason")


# --- prompts -----------------------------------------------------------------------------------------------------


def conversation_lists(spark, d):
    rows = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("s"))
    return rows.select("conv_id", F.when(F.col("conv_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.transform("s", lambda x: x["role"])).alias("roles"))


LISTS_SQL = "(SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN [] ELSE list(role ORDER BY turn) END AS roles FROM conversations GROUP BY conv_id)"


@query(f"""
SELECT conv_id,
 CASE WHEN len(roles) > 0 THEN '### Learning Objectives:' || chr(10) || array_to_string(list_transform(roles, lambda x, i: i || '. ' || x), chr(10)) ELSE '{prompts.NO_OBJECTIVES}' END AS numbered,
 CASE WHEN len(roles) > 0 THEN array_to_string(list_transform(roles, lambda x: '- ' || x), chr(10)) ELSE '{prompts.NO_OBJECTIVES}' END AS bulleted,
 CASE WHEN len(roles) > 0 THEN chr(10) || '### Learning Objectives:' || chr(10) || array_to_string(list_transform(roles, lambda x: '- ' || x), chr(10)) ELSE '' END AS system_part,
 CASE WHEN len(roles) > 0 THEN chr(10) || '### Sample Questions:' || chr(10) || array_to_string(list_transform(roles, lambda x, i: 'Question ' || i || ': ' || x), chr(10)) ELSE '' END AS samples
FROM {LISTS_SQL}""")
def prompt_sections(spark, d):
    roles = F.col("roles")
    return conversation_lists(spark, d).select("conv_id", prompts.objectives_section(roles).alias("numbered"), prompts.user_objectives(roles).alias("bulleted"), prompts.system_objectives(roles).alias("system_part"), prompts.sample_section(roles).alias("samples"))


@query(r"""
SELECT n_nationkey, 'Unit ' || n_name || ' of {' || r_name || '}: {x}' || chr(10) || chr(10) || 'Constraints:' || chr(10) || '- Ask nothing twice, not in other words either.' || chr(10) || '- Spread over topics, skills and difficulty.' || chr(10) || '- Take another angle for run_seed=seed_1.' || chr(10) AS prompt,
 CASE WHEN n_nationkey % 2 = 0 THEN 'You are m1. ' ELSE '' END || 'Be brief.' AS system_prompt
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def render_prompt(spark, d):
    rows = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = prompts.render("Unit {unit} of {{{subject}}}: {{x}}", {"unit": F.col("n_name"), "subject": F.col("r_name"), "unused": F.lit(1)})
    provider = F.when(F.col("n_nationkey") % 2 == 0, "gemini").otherwise("openai")
    return rows.select("n_nationkey", prompts.with_constraints(body, F.lit("seed_1")).alias("prompt"), prompts.for_provider(F.lit("Be brief."), provider, F.lit("m1")).alias("system_prompt"))


@query("""
SELECT c_custkey, level, level_num, CASE WHEN level_num % 2 = 0 THEN 'Ask ' || c_name || ' {' || level || '}' ELSE level || ' (' || level_num || '): ' || c_name || ', ' || c_mktsegment END AS prompt
FROM customer, (VALUES ('Remembering', 1), ('Understanding', 2), ('Applying', 3), ('Analyzing', 4), ('Evaluating', 5)) l(level, level_num)""")
def skill_bloom_cross(spark, d):
    """Templates are rows, joined by level and rendered with each skill's values."""
    skills = read(spark, d, "customer").select("c_custkey", F.col("c_name").alias("skill"), F.col("c_mktsegment").alias("subject"))
    bodies = [(k, "Ask {skill} {{{level}}}" if v % 2 == 0 else "{level} ({level_num}): {skill}, {subject}") for k, v in text.LEVELS.items()]
    rows = lookup.with_template(lookup.with_levels(skills, text.LEVELS), spark.createDataFrame(bodies, "level string, template string"))
    params = F.create_map(*[x for k in ("skill", "subject", "level", "level_num") for x in (F.lit(k), F.col(k).cast("string"))])
    return rows.select("c_custkey", "level", "level_num", prompts.render_rows(F.col("template"), params).alias("prompt"))


@query(f"""
SELECT p_partkey, 'Question: ' || p_name || CASE WHEN p_partkey % 3 <> 0 THEN chr(10) || chr(10) || 'Diagram Instructions: ' || CASE WHEN p_partkey % 3 = 1 THEN p_brand || ' ' || p_type ELSE p_type END ELSE '' END
 || chr(10) || chr(10) || '{prompts.NO_SOLUTION}' AS prompt FROM part""")
def diagram_prompt(spark, d):
    kind = F.col("p_partkey") % 3
    steps = F.when(kind == 0, F.lit('""')).when(kind == 1, F.to_json(F.array("p_brand", "p_type"))).otherwise(F.concat(F.lit('"'), "p_type", F.lit('"')))
    question = text.first_truthy(F.when(kind == 0, "").otherwise(F.col("p_name")), F.col("p_name"))
    return read(spark, d, "part").select("p_partkey", prompts.diagram_prompt(question, jsonfix.text_or_list(F.parse_json(steps))).alias("prompt"))


# --- choices -----------------------------------------------------------------------------------------------------


def choice_rows(spark, d):
    """Options from the parts of a line item's neighbours; every seventh row has a text twice, every eleventh no labels."""
    o, key = [F.concat(F.lit("t"), ((F.col("o_orderkey") * (i + 3) + (F.lit(0) if i == 2 else F.lit(i))) % (10**6)).cast("string")) for i in range(4)], F.col("o_orderkey")
    o[2] = F.when(key % 7 == 0, o[1]).otherwise(o[2])
    labelled = F.when(key % 11 == 0, F.array(*o)).otherwise(F.array(*[F.concat(F.lit("ABCD"[i] + (". " if i % 2 == 0 else ") ")), o[i]) for i in range(4)]))
    return read(spark, d, "orders").select("o_orderkey", labelled.alias("choices"), choices.letter((key % 4).cast("int")).alias("answer"))


SHUFFLE_SQL = f"""(
WITH t AS (SELECT o_orderkey, ['t' || ((o_orderkey * 3) % 1000000), 't' || ((o_orderkey * 4 + 1) % 1000000), CASE WHEN o_orderkey % 7 = 0 THEN 't' || ((o_orderkey * 4 + 1) % 1000000) ELSE 't' || ((o_orderkey * 5) % 1000000) END, 't' || ((o_orderkey * 6 + 3) % 1000000)] AS ts FROM orders WHERE o_orderkey % 11 <> 0),
s AS (SELECT o_orderkey, ts[1 + o_orderkey % 4] AS good, list_transform(list_sort(list_transform([0, 1, 2, 3], lambda i: {{'h': sha256('{SHUFFLE_SEED}|' || o_orderkey || '|' || i), 't': ts[i + 1]}})), lambda x: x.t) AS new FROM t)
SELECT o_orderkey, array_to_string(list_transform(new, lambda x, i: chr(64 + CAST(i AS INT)) || '. ' || x), '|') AS options, chr(64 + CAST(list_position(new, good) AS INT)) AS answer, chr(65 + CAST(o_orderkey % 4 AS INT)) AS old FROM s)"""


def shuffled_rows(spark, d):
    moved = choices.shuffled(F.col("choices"), F.col("answer"), F.col("o_orderkey"), SHUFFLE_SEED)
    rows = with_once(choice_rows(spark, d), "m", moved, lambda m: m.isNotNull())
    return rows.select("o_orderkey", F.array_join("m.choices", "|").alias("options"), F.col("m.answer").alias("answer"), F.col("answer").alias("old"))


@query(f"SELECT o_orderkey, options, answer FROM {SHUFFLE_SQL}")
def shuffle_choices(spark, d):
    return shuffled_rows(spark, d).drop("old")


@query(f"SELECT o_orderkey, options, answer FROM {SHUFFLE_SQL} WHERE answer <> old")
def shuffle_changed_only(spark, d):
    return shuffled_rows(spark, d).where("answer <> old").drop("old")


@query(f"SELECT count(*) AS processed, count_if(answer <> old) AS changed FROM {SHUFFLE_SQL}")
def shuffle_counters(spark, d):
    return shuffled_rows(spark, d).agg(F.count("*").alias("processed"), F.count_if(F.col("answer") != F.col("old")).alias("changed"))


@query("SELECT o_orderkey, 'no label' AS reason FROM orders WHERE o_orderkey % 11 = 0")
def choices_quarantine(spark, d):
    rows = choice_rows(spark, d).where(~choices.labelled(F.col("choices"), F.col("answer")))
    return rows.select("o_orderkey", F.lit("no label").alias("reason"))


@query(f"SELECT o.o_orderkey, coalesce(s.answer, chr(65 + CAST(o.o_orderkey % 4 AS INT))) AS answer FROM orders o LEFT JOIN {SHUFFLE_SQL} s ON s.o_orderkey = o.o_orderkey AND s.answer <> s.old")
def conditional_update(spark, d):
    """Only rows whose answer has moved are changed, in the buckets of the bank that they lie in."""
    rows = choice_rows(spark, d).select("o_orderkey", "answer")
    store = Store.open(spark, f"{folder(spark, 'bank')}/bank", rows.schema, "o_orderkey", BUCKETS)
    store.upsert(rows)
    store.update(shuffled_rows(spark, d).where("answer <> old").select("o_orderkey", "answer"), ["answer"])
    return store.read()


def field_json(k: Column) -> Column:
    """A field that is absent, null, or has one of two values."""
    return F.when(k % 4 == 0, "{}").when(k % 4 == 1, '{"v":null}').when(k % 4 == 2, '{"v":{"b":1,"a":2}}').otherwise('{"v":[3]}')


@query("""
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) % 4 AS s, event_id % 4 AS t, event_id % 11 <> 0 AS in_source, event_id % 13 <> 0 AS in_target FROM events)
SELECT event_id, 'v' AS field, CASE WHEN t = 0 THEN 'added' WHEN s = 0 THEN 'removed' WHEN s = 1 THEN 'to_null' WHEN t = 1 THEN 'from_null' ELSE 'changed' END AS status
FROM e WHERE in_source AND in_target AND s <> t""")
def field_changes(spark, d):
    """Fields of documents on both sides, where an absent field is not a null one."""
    rows = read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    source = rows.where("event_id % 11 <> 0").select("event_id", F.parse_json(field_json(F.col("k"))).alias("doc"))
    target = rows.where("event_id % 13 <> 0").select("event_id", F.parse_json(F.replace(field_json(F.col("event_id")), F.lit('{"b":1,"a":2}'), F.lit('{"a":2, "b":1}'))).alias("doc"))
    return delta.field_changes(source, target, "event_id", "doc")


@query("""
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) % 4 AS k FROM events)
SELECT event_id, CASE k WHEN 0 THEN 'missing' WHEN 1 THEN 'null' ELSE 'value' END AS presence, k <> 0 AS present FROM e""")
def field_presence(spark, d):
    rows = read(spark, d, "events").select("event_id", F.parse_json(field_json(F.get_json_object("props", "$.k").cast("int"))).alias("doc"))
    found = jsonfix.presence(F.col("doc"), "v")
    return rows.select("event_id", found.alias("presence"), (found != "missing").alias("present"))


# --- diagrams ----------------------------------------------------------------------------------------------------


def diagram_rows(spark, d):
    line = read(spark, d, "lineitem")
    steps = F.when(F.col("l_quantity") > 25, F.array(F.lit("draw"))).otherwise(F.array().cast("array<string>"))
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("subject"), F.col("l_linestatus").alias("question_type"), (F.col("l_discount") > 0.05).alias("needs"), steps.alias("steps"))


@query("""
SELECT 'R' AS asked, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_discount > 0.05 AND l_returnflag = 'R' AND l_linestatus = 'F' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT '*', l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_discount > 0.05 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def diagram_candidates(spark, d):
    rows, out = diagram_rows(spark, d), []
    done = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    for asked in ("R", "*"):
        found = lookup.diagram_candidates(rows, F.col("needs"), asked, "F")
        out.append(lookup.pending(found, done, "l_orderkey").select(F.lit(asked).alias("asked"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return out[0].unionByName(out[1])


@query("""SELECT CASE WHEN l_discount > 0.05 AND l_quantity > 25 THEN 'draw' WHEN l_discount > 0.05 THEN 'plain' ELSE 'none' END AS action, count(*) AS n FROM lineitem GROUP BY 1""")
def diagram_actions(spark, d):
    return diagram_rows(spark, d).groupBy(lookup.diagram_action(F.col("needs"), F.col("steps")).alias("action")).agg(F.count("*").alias("n"))


@query("SELECT event_id FROM events WHERE event_type = 'click' AND event_id % 2 = 0 AND user_id % 5 = 1")
def test_candidates(spark, d):
    rows = read(spark, d, "events").select("event_id", F.when(F.col("event_type") == "click", "tests").alias("question_type"), (F.col("event_id") % 2 == 0).alias("needs"), F.lit("s").alias("subject"), (F.col("user_id") % 5).cast("string").alias("skill"))
    return lookup.test_candidates(rows, F.col("needs"), "no", "1").select("event_id")


# --- vectors -----------------------------------------------------------------------------------------------------


@query("""
SELECT CAST(d.doc_id AS VARCHAR) AS question_id, lang AS document, lang || ',' || source AS keywords, '' AS prerequisites, coalesce(CAST(quality AS VARCHAR), 'unknown') AS difficulty,
 lang || ' ' || ' ' || lang || ',' || source || ' ' AS semantic_context FROM documents d LEFT JOIN labels USING (doc_id)""")
def vector_metadata(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "lang", "source").join(read(spark, d, "labels"), "doc_id", "left")
    words, none = F.array("lang", "source"), F.lit(None).cast("array<string>")
    context = text.semantic_context(F.col("lang"), F.lit(None), words, none)
    return bank.vector_record(rows, F.col("doc_id").cast("string"), F.col("lang"), {"keywords": words, "prerequisites": none}, {"difficulty": (F.col("quality").cast("string"), "unknown"), "semantic_context": (context, "")})


@query("""SELECT doc_id, coalesce(toxic = 1, false) AS diagram_required, 'offline' AS model_used, source AS meta_source, coalesce(toxic = 1, false) AS has_diagram, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 5 AS INT) END AS question_number FROM documents LEFT JOIN labels USING (doc_id)""")
def structured_metadata(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "source").join(read(spark, d, "labels"), "doc_id", "left")
    out = bank.stamp_metadata(rows, F.coalesce(F.col("toxic") == 1, F.lit(False)), F.lit("offline"), F.col("source"))
    merged = bank.merge_alignment(F.struct(F.lit("").alias("answer")), {"answer": F.lit("A")}, (F.col("doc_id") % 5).cast("int"))
    return out.withColumn("alignment", merged).select("doc_id", "diagram_required", "model_used", F.col("metadata.source").alias("meta_source"), "metadata.has_diagram", "alignment.question_number")


# --- deltas ------------------------------------------------------------------------------------------------------


def two_banks(spark, d):
    """Source: documents but each ninth; target: all but each seventh, each fifth of them with another language."""
    docs = read(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    source = docs.where("doc_id % 9 <> 0")
    target = docs.where("doc_id % 7 <> 0").withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.lit("xx")).otherwise(F.col("lang")))
    return source, target


CLASSES_SQL = """(SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'added' WHEN doc_id % 9 = 0 THEN 'deleted' WHEN doc_id % 5 = 0 THEN 'changed' ELSE 'same' END AS status FROM documents WHERE doc_id % 9 <> 0 OR doc_id % 7 <> 0)"""


def bank_classes(spark, d):
    def hashed(rows):
        return rows.select("doc_id", text.document_hash(rows.columns).alias("hash"))

    source, target = two_banks(spark, d)
    return delta.classify(hashed(source), hashed(target), "doc_id", "hash")


def delta_of(status: str) -> Query:
    return lambda spark, d: bank_classes(spark, d).where(F.col("status") == status).select("doc_id")


for _status in ("added", "deleted", "changed"):
    QUERIES[f"delta_{_status}"] = delta_of(_status)
    ORACLE_SQL[f"delta_{_status}"] = f"SELECT doc_id FROM {CLASSES_SQL} WHERE status = '{_status}'"


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'added' WHEN doc_id % 4 = 0 AND doc_id % 8 <> 0 THEN 'changed' ELSE 'same' END AS status FROM documents""")
def delta_last_read(spark, d):
    """Each fourth document is in the source twice, the second time with another language; the target has that one of each eighth."""
    docs = read(spark, d, "documents").select("doc_id", "lang")
    source = docs.withColumn("read", F.lit(0)).unionByName(docs.where("doc_id % 4 = 0").select("doc_id", F.lit("aa").alias("lang"), F.lit(1).alias("read")))
    target = docs.where("doc_id % 5 <> 0").select("doc_id", F.when(F.col("doc_id") % 8 == 0, "aa").otherwise(F.col("lang")).alias("lang"), F.lit(0).alias("read"))
    sides = [rows.select("doc_id", "read", text.document_hash(["doc_id", "lang"]).alias("hash")) for rows in (source, target)]
    return delta.classify(*sides, "doc_id", "hash", "read")


@query(f"SELECT count_if(status = 'added') AS added_count, count_if(status = 'deleted') AS deleted_count, count_if(status = 'changed') AS changed_count FROM {CLASSES_SQL}")
def delta_stats(spark, d):
    return delta.stats(bank_classes(spark, d))


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS lang, source, n_chars FROM documents WHERE doc_id % 7 <> 0
UNION ALL SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id % 7 = 0 AND doc_id % 9 <> 0""")
def delta_apply(spark, d):
    return delta.apply_added(*two_banks(spark, d), "doc_id")


@query("""SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 500) AS BIGINT) AS batch FROM orders""")
def batches(spark, d):
    return lookup.batches(read(spark, d, "orders").select("o_orderkey"), 500, "o_orderkey")


@query("SELECT doc_id, source FROM documents INTERSECT SELECT doc_id, source FROM documents WHERE doc_id % 3 = 0 EXCEPT SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0")
def set_operations(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "source")
    return docs.intersect(docs.where("doc_id % 3 = 0")).subtract(docs.where("doc_id % 2 = 0"))


# --- summaries and configuration ---------------------------------------------------------------------------------


def step_log(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return summary.chain(rows, [("prepare", F.col("o_totalprice") > 1000), ("generate", F.col("o_orderstatus") == "F"), ("store", F.col("o_orderkey") % 10 != 0)])


@query("""
WITH s AS (SELECT o_orderpriority, o_totalprice > 1000 AND o_orderstatus = 'F' AND o_orderkey % 10 <> 0 AS ok FROM orders)
SELECT o_orderpriority, count(*) AS total_processed, count_if(ok) AS successful, count(*) - count_if(ok) AS failed, printf('%.1f%%', count_if(ok) / count(*) * 100) AS success_rate, count_if(ok) > 0 AS success FROM s GROUP BY 1""")
def workflow_summary(spark, d):
    return summary.summarise(step_log(spark, d), "o_orderpriority")


@query("""SELECT CASE WHEN NOT o_totalprice > 1000 THEN 'prepare' WHEN o_orderstatus <> 'F' THEN 'generate' WHEN o_orderkey % 10 = 0 THEN 'store' END AS error, count(*) AS n FROM orders GROUP BY 1""")
def step_errors(spark, d):
    return step_log(spark, d).groupBy("error").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, (o_orderkey % 2 = 0 AND o_orderkey % 3 = 0) OR (o_orderkey % 5 = 0 AND o_orderkey % 7 = 0) AS success FROM orders""")
def sinks_outcome(spark, d):
    key = F.col("o_orderkey")
    return read(spark, d, "orders").select("o_orderkey", summary.sinks_outcome([(key % 2 == 0, key % 3 == 0), (key % 5 == 0, key % 7 == 0)]).alias("success"))


@query("""
SELECT 'user_' || user_id || '.' || event_type AS key, arg_max(json_extract_string(props, '$.k'), event_id) AS value FROM events GROUP BY 1""")
def config_flatten(spark, d):
    """Settings that users have made one after the other, in sections by kind: the last of each key counts, whatever section it is in."""
    key = F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit("."), "event_type")
    kv = read(spark, d, "events").select(F.col("event_id").alias("ord"), F.col("event_type").alias("section"), key.alias("key"), F.get_json_object("props", "$.k").alias("value"))
    return summary.flatten_config(kv)


LEVEL_NAMES = list(text.LEVELS)


@query(f"""
WITH e AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
SELECT event_id, CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN k || '' ELSE k || '|' || user_id END AS ids, {LEVEL_NAMES}[1 + k % 5] || '|other' AS levels, CAST(1 + k % 5 AS INT) AS first_level, CASE WHEN k % 3 = 0 THEN k || '' ELSE 'none' END AS setting FROM e""")
def skill_ids_parse(spark, d):
    """Lists of ids and levels as settings have them, with spaces, words between the numbers, and settings that are not there."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = read(spark, d, "events").select("event_id", "user_id", k.alias("k"))
    listed = F.when(F.col("k") % 4 == 0, "x, 1_0,-3").when(F.col("k") % 4 == 1, F.format_string("%d,,4.5", "k")).otherwise(F.format_string(" %d, x ,%d", "k", "user_id"))
    named = F.concat(F.lit(" "), F.element_at(F.array(*[F.lit(x) for x in LEVEL_NAMES]), F.col("k") % 5 + 1), F.lit(" , other"))
    settings = F.when(F.col("k") % 3 == 0, F.create_map(F.lit("setting"), F.col("k").cast("string"))).otherwise(F.create_map(F.lit("else"), F.lit("x")))
    levels = text.string_list(named)
    return rows.select(
        "event_id", F.array_join(text.int_list(listed).cast("array<string>"), "|").alias("ids"), F.array_join(levels, "|").alias("levels"), text.level_number(F.get(levels, F.lit(0))).alias("first_level"),
        summary.with_default(F.try_element_at(settings, F.lit("setting")), "none").alias("setting"),
    )


@query("""
SELECT p_partkey, replace(replace(p_name || '/' || p_brand, ' ', '_'), '/', '_') AS safe, replace(p_name, ' ', '_') AS molecule,
 CASE p_partkey % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'image' WHEN 2 THEN 'text' END AS kind, 'batch_20240102_030405' AS batch, 1234 AS seed, p_name AS question, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE '' END AS details,
 'mongodb://' || CASE WHEN p_partkey % 2 = 0 THEN 'u:p@' ELSE '' END || 'localhost:27017' AS uri, nullif(lower(split_part(p_type, ' ', 2)), '') AS subject FROM part""")
def names_and_formats(spark, d):
    even, kind = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 4
    path = F.concat("p_name", F.when(kind == 0, ".pdf").when(kind == 1, ".JPG").when(kind == 2, ".txt").otherwise(".PDF"))
    shown = F.concat(F.lit("**Extracted Question:** "), "p_name", F.when(even, F.concat(F.lit("\n---\n**Image Details:** "), "p_type")).otherwise(""))
    return read(spark, d, "part").select(
        "p_partkey", text.file_safe(F.concat("p_name", F.lit("/"), "p_brand")).alias("safe"), text.molecule_file(F.col("p_name")).alias("molecule"), text.file_kind(path).alias("kind"),
        text.batch_id(F.lit(BATCH_TIME).cast("timestamp")).alias("batch"), text.seed_suffix(F.lit("20240102_1234")).alias("seed"), jsonfix.image_text(shown).alias("i"), text.subject_of_task(F.col("p_type")).alias("subject"),
        text.server_uri(F.lit(""), F.lit(None).cast("string"), F.when(even, "u"), F.lit("p")).alias("uri")).select("*", "i.question", "i.details").drop("i")


@query("SELECT lang, count(*) AS n, min(length(text)) AS shortest, max(length(text)) AS longest, sum(length(text)) AS characters FROM documents GROUP BY lang")
def length_statistics(spark, d):
    size = F.length("text")
    return read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.min(size).alias("shortest"), F.max(size).alias("longest"), F.sum(size).alias("characters"))


@query("""
SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS subject, n_name AS subject_area, c_custkey AS skill_id, c_name AS skill, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS objectives, 15 AS num_questions, 'Applying|Evaluating' AS levels
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def skill_parameters(spark, d):
    rows = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    skills = rows.select(F.col("c_custkey").alias("skill_id"), F.col("c_name").alias("skill_name"), F.col("n_name").alias("subject_area"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("subject"), F.when(F.col("c_custkey") % 2 == 0, F.array("c_mktsegment")).alias("o"))
    out = lookup.skill_params(skills, F.col("o"), 15, ["Applying", "Evaluating"])
    return out.withColumn("objectives", F.array_join("learning_objectives", "|")).withColumn("levels", F.array_join("bloom_levels", "|")).drop("learning_objectives", "bloom_levels")


# --- contracts ---------------------------------------------------------------------------------------------------


@query(f"SELECT answer, count(*) AS n, count(*) / (SELECT count(*) FROM {SHUFFLE_SQL}) AS share FROM {SHUFFLE_SQL} GROUP BY answer")
def contract_answer_spread(spark, d):
    return contracts.answer_spread(shuffled_rows(spark, d), "answer")


@query("""SELECT o_orderkey, o_orderkey % 11 <> 0 AS four_options, true AS letter_ok FROM orders""")
def contract_options(spark, d):
    return choice_rows(spark, d).select("o_orderkey", contracts.four_options(F.col("choices")).alias("four_options"), contracts.answer_letter(F.col("answer")).alias("letter_ok"))


@query("SELECT l_returnflag, count_if(l_discount > 0.05) / count(*) AS ratio, count_if(l_discount > 0.05) / count(*) BETWEEN 0.3 AND 0.4 AS ok FROM lineitem GROUP BY 1")
def contract_diagram_ratio(spark, d):
    return contracts.diagram_ratio(read(spark, d, "lineitem").withColumn("needs", F.col("l_discount") > 0.05), "needs", 0.3, 0.4, "l_returnflag")


@query("""SELECT p_partkey, p_size % 6 + 1 BETWEEN 3 AND 5 AND p_size % 5 = p_size % 6 AS level_ok, p_partkey % 2 = 0 AS prefix_ok, p_size % 2 = p_partkey % 2 AS steps_ok, p_partkey % 3 <> 0 AS stem_ok, p_size % 4 <> 3 AS difficulty_ok, p_partkey % 5 = 0 AS verified FROM part""")
def contract_rows(spark, d):
    part, size, key = read(spark, d, "part"), F.col("p_size"), F.col("p_partkey")
    names = F.array(*[F.lit(k) for k in text.LEVELS])
    level = F.get(names, (size % 5).cast("int"))
    hints = F.when(key % 5 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a")))
    return part.select(
        "p_partkey", contracts.level_agrees(level, (size % 6 + 1).cast("int"), 3).alias("level_ok"), contracts.skill_prefixed(F.concat(F.when(key % 2 == 0, level).otherwise("None"), F.lit("-1")), level).alias("prefix_ok"),
        contracts.steps_iff_diagram(F.when(size % 2 == 0, F.array(F.lit("s"))).otherwise(F.array().cast("array<string>")), key % 2 == 0).alias("steps_ok"), contracts.plain_stem(F.when(key % 3 == 0, "see Step 1").otherwise("x")).alias("stem_ok"),
        contracts.difficulty_known(F.get(F.array(*[F.lit(x) for x in contracts.DIFFICULTIES]), (size % 4).cast("int"))).alias("difficulty_ok"), contracts.verified(hints, F.lit("A"), F.lit("B"), F.lit(False)).alias("verified"))


@query("""SELECT n_nationkey AS unit, 60 AS want, coalesce(n, 0) AS n, coalesce(n, 0) = 60 AS ok FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey""")
def contract_question_counts(spark, d):
    wanted = read(spark, d, "nation").select(F.col("n_nationkey").alias("unit"), F.lit(60).alias("want"))
    return contracts.count_matches(read(spark, d, "customer").withColumnRenamed("c_nationkey", "unit"), wanted, "unit")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def contract_objectives_covered(spark, d):
    return contracts.uncovered(read(spark, d, "customer").select("c_custkey", "c_name"), read(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


# --- workflows with the offline provider -------------------------------------------------------------------------


OWN_SQL = """'Which value has code ' || substr(own, 1, 8) || '?' AS question, substr('ABCD', CAST(1 + CAST('0x' || substr(own, 64, 1) AS BIGINT) % 4 AS INT), 1) AS correct_answer"""


@query(f"""
WITH u AS (SELECT n_nationkey AS unit_id, n_name, CAST(ceil(count(*) * 44 / 100.0) AS BIGINT) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL),
p AS (SELECT *, sha256('offline|You write exam questions for Science.|Write ' || n || ' questions on the unit ' || n_name || ' of Science.' || chr(10) || '- ' || n_name || chr(10) || chr(10) || 'Constraints:' || chr(10)
      || '- Ask nothing twice, not in other words either.' || chr(10) || '- Spread over topics, skills and difficulty.' || chr(10) || '- Take another angle for run_seed=2024-01-02 03:04:05_0.' || chr(10)) AS h FROM u),
q AS (SELECT unit_id, i, sha256(h || '|' || i) AS own FROM p, LATERAL (SELECT unnest(range(0, n)) AS i))
SELECT unit_id, question, correct_answer, sha256(question) AS hash, question_index, unit_id AS set_index, 'batch_20240102_030405' AS batch_id FROM (SELECT unit_id, CAST(i + 1 AS INT) AS question_index, {OWN_SQL} FROM q)""")
def exam_workflow(spark, d):
    from quizloom.plans.workflows import exam

    units = read(spark, d, "nation").join(read(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("weight"))
    units = units.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit"), "weight", F.array("n_name").alias("objectives"))
    return exam(spark, units, "Science", 44, BATCH_TIME).select("unit_id", "question", "correct_answer", "hash", "question_index", "set_index", "batch_id")


@query("""
WITH w AS (SELECT n_nationkey AS unit_id, n_name, count(*) AS weight FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
n AS (SELECT *, CAST(ceil(CAST(weight AS DOUBLE) * (44 + 40 * run) / 100) AS BIGINT) AS n FROM w, (VALUES (0), (1)) r(run)),
q AS (SELECT run, unit_id, n_name, unnest(range(0, n)) AS i FROM n)
SELECT run, q.unit_id, count(*) AS questions, min(sha256('What is ' || n_name || ' no. ' || i || '?')) AS first_hash
FROM q LEFT JOIN (SELECT unit_id, n AS before FROM n WHERE run = 0) b ON b.unit_id = q.unit_id AND q.run = 1 WHERE i >= coalesce(before, 0) GROUP BY ALL""")
def exam_runs(spark, d):
    """Two exams over one state: the second is larger and asks only what the first has not."""
    from quizloom.plans.workflows import exam

    def call(provider: str, system: str, user: str, settings: dict) -> str:
        import json

        unit = user.split(" on the unit ")[1].split(" of Science.")[0]
        return json.dumps({"questions": [{"question": f"What is {unit} no. {i}?"} for i in range(int(user.split(" ")[1]))]})

    state = SeenState(spark, f"{folder(spark, 'exams')}/state", buckets=BUCKETS)
    units = read(spark, d, "nation").join(read(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("weight"))
    units = units.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit"), F.col("weight").cast("double").alias("weight"), F.array("n_name").alias("objectives"))
    made = [exam(spark, units, "Science", total, BATCH_TIME, seen=state, call=call).select(F.lit(run).alias("run"), "unit_id", "hash") for run, total in enumerate((44, 84))]
    return functools.reduce(DataFrame.union, made).groupBy("run", "unit_id").agg(F.count("*").alias("questions"), F.min("hash").alias("first_hash"))


@query(f"""
WITH q AS (SELECT p_partkey, i, sha256(sha256('offline|Be brief.|On ' || p_name || ' ' || p_partkey) || '|' || i) AS own FROM part, LATERAL (SELECT unnest(range(0, 2)) AS i))
SELECT p_partkey, CAST(i AS INT) AS pos, {OWN_SQL} FROM q""")
def llm_stub_roundtrip(spark, d):
    prompt = F.concat(F.lit("On "), "p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    rows = read(spark, d, "part").select("p_partkey", F.lit("Be brief.").alias("system_prompt"), prompt.alias("user_prompt"))
    asked = providers.requests(rows, "offline")
    answers = providers.respond(asked)
    found = bank.questions_of(asked.join(answers, "request_id").select("p_partkey", "response"), "response", jsonfix.sanitize_bank)
    return found.select("p_partkey", "pos", jsonfix.field(F.col("q"), "question").alias("question"), jsonfix.field(F.col("q"), "correct_answer").alias("correct_answer"))


@query(f"""
WITH q AS (SELECT p_partkey, i, sha256(sha256(CASE WHEN p_partkey % 2 = 0 THEN 'first' ELSE 'second' END || '|Be brief.|On ' || p_name || ' ' || p_partkey) || '|' || i) AS own
           FROM part, LATERAL (SELECT unnest(range(0, 2)) AS i) WHERE p_partkey % 5 <> 0 OR p_partkey % 2 = 0)
SELECT p_partkey, CAST(i AS INT) AS pos, {OWN_SQL} FROM q""")
def journalled_calls(spark, d):
    """Two runs over one journal: what the first has an answer to is not asked in the second; each fifth of the others fails."""

    def first(provider: str, system: str, user: str, settings: dict) -> str:
        return providers.offline("first", system, user, settings)

    def second(provider: str, system: str, user: str, settings: dict) -> str:
        if user.endswith(("0", "5")):
            raise RuntimeError("down")
        return providers.offline("second", system, user, settings)

    prompt = F.concat(F.lit("On "), "p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    rows = read(spark, d, "part").select("p_partkey", F.lit("Be brief.").alias("system_prompt"), prompt.alias("user_prompt"))
    asked, path = providers.requests(rows), f"{folder(spark, 'journal')}/calls"
    providers.answers(asked.where("p_partkey % 2 = 0"), path, per_batch=5000, call=first)
    answers = providers.answers(asked, path, per_batch=5000, call=second)
    found = bank.questions_of(asked.join(answers, "request_id").select("p_partkey", "response"), "response", jsonfix.sanitize_bank)
    return found.select("p_partkey", "pos", jsonfix.field(F.col("q"), "question").alias("question"), jsonfix.field(F.col("q"), "correct_answer").alias("correct_answer"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 6 <> 0 THEN 'What does image ' || substr(sha256(p_type), 1, 8) || ' show?' END AS question,
 CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 6 <> 0 THEN strlen(p_type) || ' bytes' END AS details FROM part""")
def image_questions(spark, d):
    """Bytes in, a question and details out; each sixth image is empty, a model fails for each seventh."""
    from quizloom.plans.workflows import image_questions as flow

    def read_one(provider: str, prompt: str, content: bytes) -> str:
        if content.startswith(b"-"):
            raise ValueError(content)
        return providers.offline_reading(provider, prompt, content)

    key = F.col("p_partkey")
    content = F.when(key % 6 != 0, F.encode(F.when(key % 7 == 0, F.concat(F.lit("-"), "p_type")).otherwise(F.col("p_type")), "UTF-8"))
    images = read(spark, d, "part").select("p_partkey", content.alias("content"))
    return flow(spark, images, "p_partkey", "content", call=read_one, responses=f"{folder(spark, 'readings')}/journal", per_batch=1000)


@query("""
WITH h AS (SELECT doc_id, sha256('0|' || text) || sha256('1|' || text) AS h FROM documents),
x AS (SELECT doc_id, list_transform(range(0, 16), lambda k: CAST('0x' || h[k*8+7:k*8+8] || h[k*8+5:k*8+6] || h[k*8+3:k*8+4] || h[k*8+1:k*8+2] AS BIGINT) / 2147483648.0::DOUBLE - 1) AS v FROM h)
SELECT doc_id, CAST(list_transform(v, lambda c: c / sqrt(list_reduce(list_transform(v, lambda y: y * y), lambda p, q: p + q))) AS FLOAT[]) AS embedding FROM x""")
def embed_stub(spark, d):
    return providers.embed(read(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", vectors=lambda texts: [providers.hash_vector(t) for t in texts])


@query("SELECT p_partkey, CASE WHEN p_partkey % 6 <> 0 THEN upper(sha256(replace(p_name, ' ', '_'))) END AS content FROM part")
def image_stub(spark, d):
    """Drawn by a stand-in that fails for each sixth part; a failure leaves the others alone."""

    def draw(name: str) -> bytes:
        import hashlib

        if name.startswith("-"):
            raise ValueError(name)
        return hashlib.sha256(name.encode()).digest()

    name = text.molecule_file(F.col("p_name"))
    rows = read(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("-"), name)).otherwise(name).alias("name"))
    return providers.images(rows, "p_partkey", "name", draw).select("p_partkey", F.hex("content").alias("content"))


@query("""
WITH q AS (SELECT p_partkey, n_name, sha256(sha256('offline|You review questions.|Check and improve this question on ' || n_name || ', level Applying:' || chr(10) || p_name || chr(10) || 'Options: ["A. ' || p_brand || '"]' || chr(10) || 'Answer: A') || '|0') AS own
           FROM part JOIN nation ON n_nationkey = p_size)
SELECT p_partkey, n_name AS skill, 'Which value has code ' || substr(own, 1, 8) || '?' AS question FROM q""")
def enhance_workflow(spark, d):
    """Questions of known skills only are reviewed."""
    from quizloom.plans.workflows import enhance

    options = F.array(F.concat(F.lit("A. "), "p_brand"))
    rows = read(spark, d, "part").select("p_partkey", F.col("p_size").alias("skill_id"), F.col("p_name").alias("question"), options.alias("multiple_choices"), F.lit("A").alias("correct_answer"), F.lit("Applying").alias("level"))
    skills = read(spark, d, "nation").select(F.col("n_nationkey").alias("skill_id"), F.col("n_name").alias("skill"))
    return enhance(spark, rows, skills).select("p_partkey", "skill", F.get_json_object("enhanced", "$.questions[0].question").alias("question"))


@query(f"""
WITH l AS (SELECT * FROM (VALUES ('Remembering', 1), ('Understanding', 2), ('Applying', 3), ('Analyzing', 4), ('Evaluating', 5)) t(level, k)),
q AS (SELECT c_custkey, level, sha256(sha256('offline|Level ' || level || '.|' || k || ': ask on ' || c_name) || '|0') AS own FROM customer, l)
SELECT c_custkey AS skill_id, asked_level, pos, question, correct_answer FROM (SELECT c_custkey, level AS asked_level, CAST(0 AS INT) AS pos, {OWN_SQL} FROM q)""")
def skill_level_workflow(spark, d):
    """Each skill at each level, with the level's own pair of templates."""
    from quizloom.plans.workflows import skill_levels

    skills = read(spark, d, "customer").select(F.col("c_custkey").alias("skill_id"), F.col("c_name").alias("skill"), F.array().cast("array<string>").alias("objectives"))
    pairs = {level: (f"Level {level}.", "{level_num}: ask on {skill}") for level in text.LEVELS}
    return skill_levels(spark, skills, text.LEVELS, 1, templates=pairs).select("skill_id", "asked_level", "pos", "question", "correct_answer")


@query("""
SELECT n_name AS topic, CAST(CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 1 END AS INT) AS objectives_count, n_nationkey % 5 <> 0 AND n_nationkey % 4 <> 0 AS success,
 CASE WHEN n_nationkey % 5 = 0 THEN 'framework' WHEN n_nationkey % 4 = 0 THEN 'model' END AS error, CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 4 <> 0 THEN '{"title":"x"}' END AS cheat_sheet FROM nation""")
def cheat_sheet_workflow(spark, d):
    """A model that fails for each fourth topic; each fifth has no objective and is not asked for."""
    from quizloom.plans.workflows import cheat_sheets

    def call(provider: str, system: str, user: str, settings: dict) -> str:
        if "no. 4" in system:
            raise RuntimeError("down")
        return '```json\n{"cheat_sheet": {"title": "x"}}\n```'

    key = F.col("n_nationkey")
    objective = F.concat(F.lit("no. "), F.when(key % 4 == 0, "4").otherwise("1"))
    topics = read(spark, d, "nation").select(F.lit("s").alias("subject"), F.col("n_name").alias("topic"), F.when(key % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(objective)).alias("objectives"))
    return cheat_sheets(spark, topics, call=call)[0].select("topic", "objectives_count", "success", "error", "cheat_sheet")


# --- sinks -------------------------------------------------------------------------------------------------------


PAGED_SQL = """(SELECT page_id // 10 AS doc, CAST(row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) AS INT) AS page_number,
 CASE WHEN page_id % 17 = 3 THEN NULL ELSE page_id || ' ' || url END AS text, CASE WHEN page_id % 17 = 3 THEN 'ValueError: page' END AS error FROM pages)"""


class TextPages:
    """A text file whose pages are parted by form feeds; stands in for a reader of PDF files."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.pages = f.read().split("\f")

    def __len__(self) -> int:
        return len(self.pages)

    def page(self, number: int) -> str:
        if self.pages[number] == "bad":
            raise ValueError("page")
        return self.pages[number]

    def tables(self, number: int) -> list[list[list[str | None]]]:
        """One table of the lines with commas."""
        return [[line.split(",") for line in self.pages[number].split("\n") if "," in line]]

    def close(self) -> None:
        self.pages = []


def paged_documents(spark, d):
    """Ten pages of the table a file, written by the tasks; some pages cannot be read."""
    own = F.struct("page_id", F.when(F.col("page_id") % 17 == 3, "bad").otherwise(F.concat(F.col("page_id").cast("string"), F.lit(" "), "url")).alias("text"))
    groups = read(spark, d, "pages").groupBy(F.floor(F.col("page_id") / 10).alias("doc")).agg(F.array_sort(F.collect_list(own)).alias("pages"))  # ten a group
    texts = F.array_join(F.transform("pages", lambda p: p["text"]), "\f")
    target = f"{folder(spark, 'paged').removeprefix('file:')}/files"
    bank_tables.write_images(groups.select(F.format_string("%d.txt", "doc").alias("file"), F.encode(texts, "UTF-8").alias("content")), target)
    return paged.pages(spark, target, TextPages, "*.txt", task_bytes=20_000)


def doc_number() -> Column:
    return F.regexp_extract("doc", r"(\d+)\.txt$", 1).cast("bigint").alias("doc")


@query(f"SELECT doc, page_number, text, error FROM {PAGED_SQL}")
def paged_files(spark, d):
    """Files of several pages, read page by page in ranges; a page that fails is a row, and leaves the others of its file alone."""
    return paged_documents(spark, d).select(doc_number(), "page_number", "text", "error")


@query(f"SELECT doc, question_num, m.a AS answer, m.s AS skill, 'lo' AS learning_objective, m.u AS unit FROM {KEY_SQL} WHERE doc % 3 = 0")
def paged_answer_keys(spark, d):
    """Answer keys of every third document as files, six lines a page, each page with a head; pages without the mark are passed over."""
    rows = key_rows(spark, d).where("doc % 3 = 0").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("row_ord", F.array_join("cells", ",").alias("line")))).alias("r"))  # the orders of a customer
    lines = F.transform("r", lambda r: r["line"])
    starts = F.sequence(F.lit(1), F.size("r"), F.lit(6))
    pages_of = F.transform(starts, lambda at: F.concat(F.lit("Answer Key\nno,answer,skill,objective,unit\n"), F.array_join(F.slice(lines, at, F.lit(6)), "\n")))
    body = F.concat(F.lit("First page\n1,A,x,y,2\n3,B,x,y,4\f"), F.array_join(pages_of, "\f"))
    target = f"{folder(spark, 'keys').removeprefix('file:')}/files"
    bank_tables.write_images(rows.select(F.format_string("%d.txt", "doc").alias("file"), F.encode(body, "UTF-8").alias("content")), target)
    found = paged.answer_tables(spark, target, TextPages, "*.txt", task_bytes=100_000)
    return pages.answer_key(found.where("error IS NULL")).select(doc_number(), "question_num", "answer", "skill", "learning_objective", "unit")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0 THEN upper(sha256('drawn anew: ' || s_name)) END AS digest FROM supplier")
def image_to_image(spark, d):
    """Images drawn anew from their bytes; each fourth has none, and a model fails for each third."""

    def draw(content: bytes) -> bytes:
        if content is None or content.startswith(b"-"):
            raise ValueError(content)
        return b"drawn anew: " + content

    key = F.col("s_suppkey")
    content = F.when(key % 4 != 0, F.encode(F.when(key % 3 == 0, F.concat(F.lit("-"), "s_name")).otherwise(F.col("s_name")), "UTF-8"))
    made = providers.images(read(spark, d, "supplier").select("s_suppkey", content.alias("content")), "s_suppkey", "content", draw)
    return made.select("s_suppkey", F.upper(F.sha2("content", 256)).alias("digest"))


@query(f"""
SELECT 'good' AS outcome, count(*) AS n, (SELECT count(*) FROM {PAGED_SQL} WHERE error IS NULL) AS kept FROM {PAGED_SQL} WHERE error IS NULL
UNION ALL SELECT 'rejected', count(*), (SELECT count(*) FROM {PAGED_SQL} WHERE error IS NOT NULL) FROM {PAGED_SQL} WHERE error IS NOT NULL""")
def outcome_counts(spark, d):
    """Good and rejected pages in one write, counted by it: the files are parsed once."""
    good, rejected, counts = paged.write_outcomes(paged_documents(spark, d), F.col("error"), f"{folder(spark, 'outcomes')}/pages")
    n = {"good": counts["n"] - counts["rejected"], "rejected": counts["rejected"]}
    sides = [side.agg(F.lit(name).alias("outcome"), F.lit(n[name]).cast("bigint").alias("n"), F.count("*").alias("kept")) for name, side in (("good", good), ("rejected", rejected))]
    return sides[0].union(sides[1])


@query(f"SELECT count(*) AS processed, count(CASE WHEN s.answer <> s.old THEN 1 END) AS updated, count(CASE WHEN s.o_orderkey IS NULL THEN 1 END) AS unlabelled, count(*) AS written FROM orders o LEFT JOIN {SHUFFLE_SQL} s USING (o_orderkey)")
def counted_write(spark, d):
    """A bank is shuffled, written and counted in one pass."""
    moved = choices.shuffled(F.col("choices"), F.col("answer"), F.col("o_orderkey"), SHUFFLE_SEED)
    rows = with_once(choice_rows(spark, d), "m", moved)
    path = f"{folder(spark, 'bank')}/bank"
    counts = bank_tables.counted(rows, lambda out: out.write.parquet(path), updated=F.col("m.answer") != F.col("answer"), unlabelled=F.col("m").isNull())
    told = [F.lit(counts[k]).cast("bigint").alias(name) for k, name in (("n", "processed"), ("updated", "updated"), ("unlabelled", "unlabelled"))]
    return spark.read.parquet(path).agg(*told, F.count("*").alias("written"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'first' ELSE 'second' END AS run FROM documents")
def append_new_rows(spark, d):
    """Half of the documents, then all of them twice: each is in the bank once, as it came first."""
    path, docs = folder(spark, "bank"), read(spark, d, "documents").select("doc_id")
    bank_tables.append_new(docs.where("doc_id % 2 = 0").withColumn("run", F.lit("first")), f"{path}/bank", "doc_id")
    for run in ("second", "third"):
        bank_tables.append_new(docs.union(docs).withColumn("run", F.lit(run)), f"{path}/bank", "doc_id")
    return spark.read.parquet(f"{path}/bank")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'aa' END AS lang FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0")
def vector_upsert(spark, d):
    """Three runs over one table, one of them without rows; each finds the newest version by itself."""
    path, docs = f"{folder(spark, 'vectors')}/table", read(spark, d, "documents").select("doc_id", "lang")
    Store.open(spark, path, docs.schema, "doc_id", BUCKETS)
    for rows in (docs.where("doc_id % 2 = 0").withColumn("lang", F.lit("aa")), docs.limit(0), docs.where("doc_id % 3 = 0")):
        store = bank_tables.upsert(rows, path, "doc_id")
    return store.read()


@query("SELECT mode, p_partkey, p_name FROM part, (VALUES ('file'), ('table')) m(mode) UNION ALL SELECT 'table', p_partkey, p_name FROM part WHERE p_partkey % 2 = 0")
def output_modes(spark, d):
    """Rows written as JSON lines and as a table, to which some are appended."""
    path, part = folder(spark, "outputs"), read(spark, d, "part").select("p_partkey", "p_name")
    for mode in ("file", "table"):
        bank_tables.write_output(part, mode, f"{path}/{mode}")
    bank_tables.write_output(part.where("p_partkey % 2 = 0"), "table", f"{path}/table")
    lines = spark.read.schema(part.schema).json(f"{path}/file").select(F.lit("file").alias("mode"), "*")
    return lines.union(spark.read.parquet(f"{path}/table").select(F.lit("table").alias("mode"), "*"))


@query("""
SELECT sink, grp, status, n, kept, status = 'saved' OR bool_or(status = 'saved') OVER (PARTITION BY grp) AS success FROM (
 SELECT sink, coalesce(grp, '') AS grp, CASE WHEN sink = 'file' AND bad > 0 OR sink = 'table' AND bad > 0 AND grp = 'en' THEN 'failed' ELSE 'saved' END AS status, n,
  CASE WHEN sink = 'file' AND bad > 0 OR sink = 'table' AND bad > 0 AND grp = 'en' THEN 0 ELSE n END AS kept
 FROM (SELECT lang AS grp, count(*) AS n, count(CASE WHEN lang IN ('de', 'en') AND doc_id % 10 = 3 THEN 1 END) AS bad FROM documents GROUP BY lang), (VALUES ('file'), ('table')) s(sink))""")
def sinks_partial(spark, d):
    """Documents by language to two sinks: the first cannot take some German and English rows, the second not those that are English; what a sink has is what was published there."""

    def line(row: dict) -> str:
        if row["lang"] in ("de", "en") and row["doc_id"] % 10 == 3:
            raise ValueError(row["doc_id"])
        return str(row["doc_id"])

    def record(row: dict) -> str:
        if row["lang"] == "en" and row["doc_id"] % 10 == 3:
            raise ValueError(row["doc_id"])
        return f'{{"doc_id": {row["doc_id"]}}}'

    path = folder(spark, "sinks")
    sinks = [Sink("file", f"{path}/file", line), Sink("table", f"{path}/table", record)]
    delivery = Delivery(spark, f"{path}/status", sinks)
    status = delivery.run("r1", read(spark, d, "documents").select("doc_id", "lang"), "lang")
    kept = [spark.read.schema("value string, grp string").option("basePath", f"{s.path}/run=r1").text(f"{s.path}/run=r1").groupBy("grp").agg(F.count("*").alias("kept")).withColumn("sink", F.lit(s.name)) for s in sinks]
    kept = kept[0].union(kept[1]).withColumn("grp", F.when(F.col("grp").isNull(), "").otherwise(F.col("grp")))
    rows = status.join(kept, ["sink", "grp"], "left").join(delivery.outcome("r1"), "grp")
    return rows.select("sink", "grp", "status", "n", F.coalesce("kept", F.lit(0)).cast("bigint").alias("kept"), "success")


@query("SELECT o_custkey AS key, count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 3 <> 2)")
def state_versions(spark, d):
    """Seen keys of three runs, the second of which has nothing new and makes no version."""
    path, keys = f"{folder(spark, 'state')}/state", read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    for run in (0, 0, 1):
        state = SeenState(spark, path, "key", "bigint", BUCKETS)
        state.add(keys.where(f"o_orderkey % 3 = {run}"))
    return state.read().select("key", F.lit(state.keys.manifest().rows).cast("bigint").alias("n"))


@query("""
WITH k AS (SELECT DISTINCT o_custkey AS key, o_orderkey % 2 AS run FROM orders), s AS (SELECT key, min(run) AS run FROM k GROUP BY key)
SELECT key, row_number() OVER (PARTITION BY v ORDER BY key) - 1 AS place, v AS version FROM s, (VALUES (1::BIGINT), (2)) t(v) WHERE run < v""")
def state_in_order(spark, d):
    """Both versions of a state of two runs, each in key order: the older one stays readable."""
    keys = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    state = SeenState(spark, f"{folder(spark, 'state')}/state", "key", "bigint", BUCKETS)
    for run in (0, 1):
        state.add(keys.where(f"o_orderkey % 2 = {run}"))
    first, second = state.in_order(1), state.in_order(2)
    return first.withColumn("version", F.lit(1).cast("bigint")).union(second.withColumn("version", F.lit(2).cast("bigint")))


# --- files and settings ----------------------------------------------------------------------------------------------


@query("SELECT replace(p_brand || ' ' || (p_size % 3) || '_x', ' ', '_') AS name, p_partkey || ' ' || p_name AS value FROM part")
def text_files(spark, d):
    """Raw texts in a folder for each brand and size, read back by the folder's name."""
    path, part = f"{folder(spark, 'texts')}/texts", read(spark, d, "part")
    bank_tables.write_texts(part, F.concat("p_brand", F.lit(" "), (F.col("p_size") % 3).cast("string"), F.lit("/x")), F.concat(F.col("p_partkey").cast("string"), F.lit(" "), "p_name"), path)
    return spark.read.schema("value string, name string").text(path).select("name", "value")


@query("SELECT s_suppkey || '' AS id, upper(sha256(s_name || 'é')) AS digest FROM supplier WHERE s_suppkey % 3 <> 0")
def image_files(spark, d):
    """Payloads in base64, some missing, as a file each; the files tell which outputs are there."""
    path = f"{folder(spark, 'images').removeprefix('file:')}/images"
    payload = F.when(F.col("s_suppkey") % 3 != 0, F.base64(F.encode(F.concat("s_name", F.lit("é")), "UTF-8")))
    bank_tables.write_images(bank_tables.image_rows(read(spark, d, "supplier"), "s_suppkey", payload), path)
    found = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"diagram_([^/]*)\.png$", 1).alias("id"), F.upper(F.sha2("content", 256)).alias("digest"))
    return files.output_ids(spark, path).join(found, "id")


@query("""
SELECT name AS provider, s_suppkey, CASE name WHEN 'gemini' THEN '{}' WHEN 'anthropic' THEN '{"max_tokens":8000,"temperature":0.5}' WHEN 'deepseek' THEN '{"max_tokens":1000,"temperature":0.5,"timeout":30,"top_p":0.9}'
 WHEN 'grok' THEN '{"seed":' || s_suppkey || ',"temperature":0.5,"top_p":0.9}' ELSE '{"frequency_penalty":0.1,"presence_penalty":0.2,"temperature":0.5,"top_p":0.9}' END AS settings,
 CASE WHEN name IN ('gemini', 'anthropic') THEN 'You are m. ' ELSE '' END || 'Be brief.' AS system_prompt
FROM supplier, (VALUES ('openai'), ('gemini'), ('deepseek'), ('anthropic'), ('grok')) p(name)""")
def provider_requests(spark, d):
    """What each provider is asked with: the settings that it honours, and its own fixed ones."""
    rows = read(spark, d, "supplier").select("s_suppkey", F.lit("Be brief.").alias("system_prompt"), F.col("s_name").alias("user_prompt"), F.col("s_suppkey").alias("seed"))
    settings = {"temperature": 0.5, "top_p": 0.9, "presence_penalty": 0.2, "frequency_penalty": 0.1}
    asked = [providers.requests(rows, name, model="m", settings=settings, per_row=("seed",)).withColumn("provider", F.lit(name)) for name in providers.PROVIDERS]
    return functools.reduce(DataFrame.unionByName, asked).select("provider", "s_suppkey", "settings", "system_prompt")


@query(f"""
SELECT 'ids' AS found_by, c_custkey, c_name FROM customer WHERE c_custkey IN ({', '.join(map(str, ASKED))}) AND c_custkey IN (SELECT o_custkey FROM orders UNION ALL SELECT c_custkey FROM customer)
UNION ALL SELECT 'ids', c_custkey, c_name FROM customer WHERE c_custkey = 3
UNION ALL SELECT 'task', c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def skill_resolution(spark, d):
    """By ids, if there are any, in spite of a task; by the task's name else."""
    customer = read(spark, d, "customer")
    skills, tasks = customer.select("c_custkey", "c_name"), customer.select("c_custkey", F.col("c_mktsegment").alias("task_name"))
    found = {"ids": lookup.resolve_skills(spark, skills, tasks, ASKED, "BUILDING", "c_custkey"), "task": lookup.resolve_skills(spark, skills, tasks, [], "BUILDING", "c_custkey")}
    sides = [rows.select(F.lit(by).alias("found_by"), "c_custkey", "c_name") for by, rows in found.items()]
    return sides[0].union(sides[1])


@query("""SELECT page_id, 'Extract the questions of this page on T{' || (page_id % 3) || '} (diagram: ' || (page_id % 2 = 0) || '):' || chr(10) || coalesce(url, '') AS prompt FROM pages""")
def page_prompts(spark, d):
    from quizloom.plans.workflows import PAGE_USER

    topic = F.concat(F.lit("T{"), (F.col("page_id") % 3).cast("string"), F.lit("}"))
    params = {"topic": topic, "diagram": F.col("page_id") % 2 == 0, "page": F.coalesce("url", F.lit(""))}
    return read(spark, d, "pages").select("page_id", prompts.render(PAGE_USER, params).alias("prompt"))


@query("""
WITH q AS (SELECT p_partkey, sha256(sha256('offline|You vary questions.|Write 2 questions like this one:' || chr(10) || p_name) || '|1') AS own FROM part)
SELECT p_partkey AS doc, CASE WHEN p_partkey % 4 <> 0 THEN 'Which value has code ' || substr(own, 1, 8) || '?' END AS second, CASE WHEN p_partkey % 4 = 0 THEN 'no json' END AS raw_output FROM q""")
def similar_workflow(spark, d):
    """Questions like a sample; an answer that is no JSON is kept as it came."""
    from quizloom.plans.workflows import similar

    def call(provider: str, system: str, user: str, settings: dict) -> str:
        return "no json" if user.endswith(" ") else providers.offline(provider, system, user, settings)

    rows = read(spark, d, "part").select(F.col("p_partkey").alias("doc"), F.concat(F.lit(" "), "p_name").alias("text"), F.when(F.col("p_partkey") % 4 == 0, " ").otherwise("").alias("end"))
    made = similar(spark, rows, 2, call=call, user="Write {num_questions} questions like this one:\n{sample_question}{end}")
    return made.select("doc", F.get_json_object("questions", "$.questions[1].question").alias("second"), "raw_output")


@query("""
SELECT p_partkey, concat_ws('|', '', 'None', p_type, 'None', p_name, n_name, '', p_size || '', '["A. ' || p_brand || '","B. x"]', 'A', CASE WHEN p_partkey % 2 = 0 THEN 'Applying' ELSE '' END, CASE WHEN p_partkey % 2 = 0 THEN '3' ELSE '0' END, 'False', '[]', '', '[]') AS prompt
FROM part JOIN nation ON n_nationkey = p_size""")
def enhance_parameters(spark, d):
    """All that an enhancement prompt may name, with what stands for missing values."""
    from quizloom.plans.workflows import ENHANCE_DEFAULTS, enhance

    def call(provider: str, system: str, user: str, settings: dict) -> str:
        import json

        return json.dumps({"asked": user})

    even = F.col("p_partkey") % 2 == 0
    own = {"skill_id": F.col("p_size"), "question": F.col("p_name"), "multiple_choices": F.array(F.concat(F.lit("A. "), "p_brand"), F.lit("B. x")), "correct_answer": F.lit("A"), "level": F.when(even, "Applying"), "level_num": F.when(even, 3), "subject_area": F.col("p_type")}
    rows = read(spark, d, "part").select("p_partkey", *[c.alias(k) for k, c in own.items()])
    skills = read(spark, d, "nation").select(F.col("n_nationkey").alias("skill_id"), F.col("n_name").alias("skill"))
    made = enhance(spark, rows, skills, call=call, user="|".join(f"{{{name}}}" for name in ENHANCE_DEFAULTS))
    return made.select("p_partkey", F.get_json_object("enhanced", "$.asked").alias("prompt"))


@query(ORACLE_SQL["exam_workflow"])
def exam_file(spark, d):
    """The exam as a JSON file, read back."""
    path, made = f"{folder(spark, 'exam')}/exam", exam_workflow(spark, d)
    bank_tables.write_output(made, "file", path)
    return spark.read.schema(made.schema).json(path)


@query("""
WITH a AS (SELECT count(*) AS n FROM documents WHERE doc_id % 9 <> 0 AND doc_id % 7 = 0), g AS (SELECT count(*) AS n FROM documents WHERE doc_id % 9 = 0 AND doc_id % 7 <> 0),
c AS (SELECT count(*) AS n FROM documents WHERE doc_id % 9 <> 0 AND doc_id % 7 <> 0 AND doc_id % 5 = 0)
SELECT run, CASE WHEN run = 'third' THEN 0 ELSE a.n END AS added_count, g.n AS deleted_count, c.n AS changed_count, CASE WHEN run = 'second' THEN a.n ELSE 0 END AS synced_count FROM a, g, c, (VALUES ('dry'), ('second'), ('third')) r(run)""")
def sync_job(spark, d):
    """The maintenance job from its arguments: a dry run, a run, and a run with nothing left to add."""
    from quizloom.__main__ import arguments, run

    path, docs = folder(spark, "jobs"), read(spark, d, "documents").select("doc_id", "lang")
    docs.where("doc_id % 9 <> 0").write.parquet(f"{path}/source")
    docs.where("doc_id % 7 <> 0").withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "xx").otherwise(F.col("lang"))).write.parquet(f"{path}/target")
    call = ["sync", "--source", f"{path}/source", "--target", f"{path}/target", "--id-field", "doc_id"]
    told = [(name, run(spark, arguments([*call, *more]))) for name, more in (("dry", ["--dry-run"]), ("second", []), ("third", []))]
    counts = ["added_count", "deleted_count", "changed_count", "synced_count"]
    return spark.createDataFrame([(name, *[c[k] for k in counts]) for name, c in told], "run string, " + ", ".join(f"{k} bigint" for k in counts))


@query("SELECT n_nationkey AS doc, 'pdf' AS kind, n_name || ' first' AS text FROM nation WHERE n_nationkey % 5 <> 0 UNION ALL SELECT s_suppkey + 1000, 'text', s_name FROM supplier")
def first_pages(spark, d):
    """The first page of each paged file and the whole of each text file; files that cannot be read are left out, and told apart."""

    def pages(content: bytes) -> list[str]:
        if content == b"broken":
            raise ValueError(content)
        return content.decode().split("\f")

    paged_files = read(spark, d, "nation").select(F.format_string("%d.pdf", "n_nationkey").alias("file"), F.when(F.col("n_nationkey") % 5 == 0, "broken").otherwise(F.concat("n_name", F.lit(" first\fsecond"))).alias("body"))
    texts = read(spark, d, "supplier").select(F.format_string("%d.txt", F.col("s_suppkey") + 1000).alias("file"), F.col("s_name").alias("body"))
    path = f"{folder(spark, 'questions').removeprefix('file:')}/files"
    bank_tables.write_images(paged_files.union(texts).select("file", F.encode("body", "UTF-8").alias("content")), path)
    return files.question_files(spark, path, pages=pages).select(F.regexp_extract("doc", r"(\d+)\.\w+$", 1).cast("bigint").alias("doc"), "kind", "text")


@query("SELECT lower(split_part(s_name, '#', 1)) || (s_suppkey % 3) AS subject, count(*) AS n FROM supplier GROUP BY 1")
def task_subjects(spark, d):
    """A configuration file for each supplier; the subject is the second word of the task's name."""
    from quizloom.sources.config import task_config

    name = F.concat(F.lit("AP  "), F.split_part("s_name", F.lit("#"), F.lit(1)), (F.col("s_suppkey") % 3).cast("string"), F.lit(" Exam"))
    body = F.concat(F.lit('{"database": {}, "prompts": {}, "pdf": {"pages": [1]}, "task": '), F.to_json(F.struct(name.alias("name"))), F.lit("}"))
    path = f"{folder(spark, 'tasks').removeprefix('file:')}/tasks"
    bank_tables.write_images(read(spark, d, "supplier").select(F.format_string("%d.json", "s_suppkey").alias("file"), F.encode(body, "UTF-8").alias("content")), path)
    return task_config(spark, path).groupBy("subject").agg(F.count("*").alias("n"))
