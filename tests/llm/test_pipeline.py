"""The stages of the pipeline against brute force, their edges, and the driver queries of the package."""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from quizloom.llm import queries
from quizloom.llm.queries import vocabulary_path
from tests.llm.brute import edited_and_next, likeness, pieces
from tests.llm.test_edges import TEXTS, expected_words, near, repeats

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
here = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 5 == 0 else "de" if k % 2 else "en", None if k % 7 == 0 else f"s{k % 3}", len(t) if t else None) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS)


def firsts(texts):
    """Numbers of the rows that stay when each group of near-duplicates keeps the one with the smallest id, rows without id last."""
    groups: dict = {}
    for k, (_, _, group, _) in enumerate(near([(k, t) for k, (_, t) in enumerate(texts)], 5)):
        groups.setdefault(group, []).append(k)
    return sorted(min(g, key=lambda k: (texts[k][0] is None, texts[k][0] or 0, k)) for g in groups.values())


def test_rows_without_or_with_equal_ids(spark):
    """Near copies go whatever their ids; other texts of the same id stay."""
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(60))
    rows = [(None, words("a")), (None, words("a") + " end"), (5, words("b")), (5, words("c")), (7, words("b") + " end"), (9, words("a")), (None, words("d")), (None, None), (None, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(9, words("a")), (5, words("b")), (5, words("c")), (None, words("d")), (None, None), (None, ""), (8, None)], key=str)


def test_stages_on_edges(spark, docs):
    first = pipeline.identify_language(spark, docs, "")
    assert first.columns == docs.columns
    kept = {(r.doc_id, r.text) for r in first.collect()}
    assert kept <= {(i, t) for i, t in TEXTS if any(c.isalpha() for c in t or "")}
    near_kept = sorted(map(str, ((r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs, "").collect())))
    assert near_kept == sorted(str(TEXTS[k]) for k in firsts(TEXTS)) and len(near_kept) < len(TEXTS) - 2
    cut = pipeline.drop_repeated_passages(spark, docs, "")
    assert cut.columns == docs.columns
    assert sorted(expected_words(r.text) for r in cut.collect()) == sorted(w[4] for w in repeats(TEXTS, 25))
    assert all(r.n_chars == (len(r.text) if r.text else r.n_chars) for r in cut.collect())
    mixed = pipeline.mix_sources(spark, docs, "")
    assert mixed.columns == docs.columns and set(map(str, mixed.collect())) <= set(map(str, docs.collect()))
    library = Tokenizer.from_file(vocabulary_path())
    for r in pipeline.encode(spark, docs, "").collect():
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    assert sorted(map(str, (r.ids for r in pipeline.encode(spark, docs, "").collect()))) == sorted(str(library.encode(t or "", add_special_tokens=False).ids) for _, t in TEXTS)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_on_nothing(spark, name):
    out = dict(pipeline.STAGES)[name](spark, spark.createDataFrame([], DOCS), "")
    assert out.collect() == []


def test_run_against_brute_force(spark, docs, tmp_path):
    """Every stage's rows, each from those of the stage before: all that run() returns, no more and no less."""
    import duckdb
    import pyarrow as pa

    from quizloom.llm import lang_id, mixing

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    model = lang_id.train(docs.select("doc_id", "text", "lang"))
    floor = min(1.0, 1.2 / len(model.langs))
    rows = [(r.doc_id, r.text, r.lang or r.lang_pred, r.source, r.n_chars) for r in lang_id.predict(docs, model).collect() if r.lang_pred != "und" and r.score >= floor]
    assert len(rows) > 10
    rows = [rows[k] for k in firsts([r[:2] for r in rows])]
    cut = list(repeats([r[:2] for r in rows], 25))
    short = [(i, w, lang, source) for (i, _, lang, source, _), (_, _, _, _, w) in zip(rows, cut, strict=True)]
    stages = dict(pipeline.STAGES)
    after = spark.createDataFrame(rows, DOCS)
    after = stages["substring_dedup"](spark, after, "")
    assert sorted(str((r.doc_id, expected_words(r.text), r.lang, r.source)) for r in after.collect()) == sorted(map(str, short))
    con = duckdb.connect()
    con.register("documents", after.toArrow())
    mixed = con.execute(f"SELECT doc_id, text, lang, source FROM ({mixing.MIX_SQL})").fetchall()
    library = Tokenizer.from_file(vocabulary_path())
    want = sorted(str((i, lang, source, library.encode(t or "", add_special_tokens=False).ids)) for i, t, lang, source in mixed)
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.lang, r.source, r.ids)) for r in got) == want and len(want) > 5


@here
def test_run(spark):
    out = pipeline.run(spark, DATA).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect()}
    assert out and {r.doc_id for r in out} <= ids


@here
def test_language_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1")
    kept = pipeline.identify_language(spark, docs, DATA)
    assert docs.join(labels, "doc_id", "left_semi").join(kept, "doc_id", "left_anti").count() == 0


@here
def test_held_out_accuracy(spark):
    folder = DATA.replace("0.001", "0.01")
    got = queries.op1_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


@here
def test_quality_tells_labels_apart(spark):
    folder = DATA.replace("0.001", "0.01")
    got = queries.op4_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, bad = ([r.kept for r in got if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.4


@here
def test_near_duplicates_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op10_near_duplicates(spark, DATA).collect())) == sorted(near(rows, 4))
    assert re.fullmatch(r"[0-9a-f]{64}", queries.op9_substrings(spark, DATA).first().kept_sha256)


@here
def test_fingerprints_and_passages_of_the_table(spark):
    """Rows of the driver's queries against brute force over the whole table."""
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(pieces(t), pieces(e)), likeness(pieces(t), pieces(after))) for i, t, e, after in edited_and_next(rows)]
    got = queries.op3_fingerprints(spark, DATA).select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    got = queries.op9_substrings(spark, DATA).collect()
    assert sorted(map(tuple, got)) == sorted(w[:4] for w in repeats(rows, 13))


def test_the_order_of_mixing_is_kept(spark, docs, tmp_path, monkeypatch):
    """Ordered by part and place, the last stage's rows are those of mixing by their shuffle key, however the files are read."""
    from quizloom.llm import mixing

    rows = docs.sparkSession.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "concat('s', id % 3) AS source", "CAST(7 AS BIGINT) AS n_chars")
    mixed = mixing.mix(rows.repartition(8))
    want = [r.doc_id for r in mixed.collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mixed.select(docs.columns).write.parquet(f"{tmp_path}/mixed")
        out = pipeline.encode(spark, spark.read.parquet(f"{tmp_path}/mixed"), "")
        assert out.select("part").distinct().count() > 1
        assert [r.doc_id for r in out.orderBy("part", "place").collect()] == want
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert pipeline.encode(spark, docs, "").where("part IS NOT NULL OR place IS NOT NULL").count() == 0
