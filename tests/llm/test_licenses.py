"""Licence templates against regular expressions and the query's SQL, with all odd rows."""

from __future__ import annotations

import re

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quizloom.llm import licenses
from quizloom.llm.license_templates import TEMPLATES
from quizloom.llm.queries import op11_licenses

MIT = next(m for label, m in TEMPLATES if label == "mit" and "<<" in m)
PLAIN_MIT = MIT.replace("[[", "").replace("]]", "").replace("<<holders:1-20>>", "authors or copyright holders")
TEXTS = [
    (1, "Released under the MIT License."), (2, PLAIN_MIT), (3, PLAIN_MIT.replace("free of charge", "for a fee")), (4, PLAIN_MIT.replace("(including the next paragraph)", "")), (5, None), (6, ""), (7, " .-\n"),
    (8, "Apache License, Version 2.0. APACHE-LICENSE version 2 apache license version 22"), (9, "cc by nc cc by nc 4.0 licensed under the CC BY-NC 4.0"), (None, "under the mit license"), (1, "Released under the MIT License."),
    (10, "x " * 60_000 + "under the mit license"), (11, "under the mit licenseé under the mit лицензия"), (12, "Copyright (c) 2001-2003 A. Holder and others. All rights reserved."), (13, "copyright all rights reserved"),
    (14, "under the terms of the gnu general public license as published by the free software foundation, either version 3"), (15, "under the " * 500 + "mit license"),
]
A, B = st.sampled_from([b"a", b"b", b"c"]), st.sampled_from([b"a", b"b", b"c", b"d"])
REGION = st.recursive(A | st.tuples(st.integers(0, 1), st.integers(1, 3)), lambda x: st.lists(x, min_size=1, max_size=3), max_leaves=5)


def as_markup(parts):
    return " ".join(p.decode() if isinstance(p, bytes) else f"[[{as_markup(p)}]]" if isinstance(p, list) else f"<<x:{p[0]}-{p[1]}>>" for p in parts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(A, st.lists(REGION, max_size=4), A), min_size=1, max_size=3), st.lists(B, max_size=30))
def test_places_equal_those_of_regular_expressions(templates, words):
    rules = [("x", as_markup([a, *middle, z]), False) for a, middle, z in templates]
    automaton = licenses.Automaton(rules)
    got = automaton.scan(words)
    text = b" ".join(words).decode() + " "
    want = []
    for at in range(len(words)):
        rest = text.split(" ", at)[at]
        for n, (_, markup, _) in enumerate(rules):
            ends = [e for e in range(len(words) - at, 0, -1) if re.fullmatch(licenses.as_pattern(licenses.parse(markup)), " ".join(rest.split(" ")[:e]) + " ")]
            want += [(at, n, at + ends[0])] if ends else []
    assert got == want


def test_markup_errors():
    for bad in ("[[a]] b", "a <<x:0-2>>", "a [[b", "a ]] b", "", " -"):
        with pytest.raises(ValueError):
            licenses.parse(bad)


def test_query_equals_sql(spark, tmp_path):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS], "doc_id long, text string, spans string, n_words int")
    rows.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = op11_licenses(spark, str(tmp_path))
    got = [tuple(r) for r in out.collect()]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in TEXTS], pa.int64()), "text": pa.array([t for _, t in TEXTS])}))
    assert sorted(got, key=str) == sorted(con.execute(licenses.license_sql()).fetchall(), key=str)
    of = {r.doc_id: r for r in out.collect()}
    assert of[2].labels == of[4].labels == "mit" and of[3].labels == "" and of[2].base_labels == "" and of[2].score > 0.99
    assert (of[8].n_base, of[8].first_word, of[8].last_word) == (2, 0, 5) and of[9].labels == "cc-by-nc,cc-by-nc-4.0" and of[9].n_base == 3
    assert (of[5].n_words, of[5].n_base, of[5].first_word, of[5].labels, of[5].score) == (0, 0, None, "", 0.0)
    assert of[12].labels == "proprietary" and of[13].labels == "" and of[14].labels == "gpl-3.0" and of[15].base_labels == "mit" and of[15].first_word == 998


def test_spans_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "Under the terms of the MIT license", "k")], "doc_id long, text string, extra string")
    r = licenses.scan(rows).first()
    assert (r.extra, r.n_words) == ("k", 7) and [(s.label, s.base, s.start, s.stop, s.wording) for s in r.spans] == [("mit", False, 0, 7, 7)]
    assert licenses.scan(rows.limit(0)).collect() == [] and licenses.scan(rows, [], {}).first().spans == []
