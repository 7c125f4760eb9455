"""Paged files read in ranges, and outcomes written in one pass."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from quizloom.sources import paged


class Text:
    """Pages parted by form feeds; a page ``bad`` and a file that begins with ``!`` cannot be read. Pages read are counted by files beside."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            body = f.read()
        if body.startswith("!"):
            raise KeyError("broken")
        self.pages, self.folder = body.split("\f"), f"{os.path.dirname(path)}-read"

    def __len__(self):
        return len(self.pages)

    def page(self, number):
        if os.path.isdir(self.folder):
            open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        if self.pages[number] == "bad":
            raise ValueError(number)
        return self.pages[number]

    def tables(self, number):
        return [[line.split(",") for line in part.split("\n") if "," in line] for part in self.pages[number].split("--")]

    def close(self):
        self.pages = []


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "docs"
    path.mkdir()
    os.mkdir(f"{path}-read")
    for name, body in (("a.txt", "one\fbad\f\fvier"), ("b.txt", "!"), ("big.txt", "\f".join(f"page {i}" for i in range(500))), (".hidden.txt", "x"), ("c.pdf", "x"), ("empty.txt", "")):
        (path / name).write_text(body)
    return str(path)


@pytest.mark.parametrize("task_bytes", [100, 10**9])
def test_pages(spark, folder, task_bytes):
    df = paged.pages(spark, folder, Text, "*.txt", task_bytes)
    got = sorted(((os.path.basename(r.doc), r.page_number, r.text, r.error) for r in df.collect()), key=str)
    want = [("a.txt", 1, "one", None), ("a.txt", 2, None, "ValueError: 1"), ("a.txt", 3, "", None), ("a.txt", 4, "vier", None), ("b.txt", None, None, "KeyError: 'broken'"), ("empty.txt", 1, "", None)]
    assert got == sorted(want + [("big.txt", i + 1, f"page {i}", None) for i in range(500)], key=str)
    assert (df.rdd.getNumPartitions() > 20) == (task_bytes == 100)


def test_plan():
    files = [("a", 10), ("b", 950), ("c", 5), ("d", 300), ("e", 0)]
    got = paged.plan(files, 100, lambda p: {"b": 7, "d": None}[p])
    ranges = [p.ranges for p in got]
    assert [r[0] for r in ranges if r[0][0] == "b"] == [("b", k, k + 1) for k in range(7)]
    assert sorted(x for r in ranges for x in r if x[0] != "b") == [(f, 0, None) for f in "acde"] and paged.plan([], 100, len) == []


def test_empty_folder(spark, tmp_path):
    assert paged.pages(spark, str(tmp_path), Text).collect() == []


def test_outcomes_in_one_pass(spark, folder, tmp_path):
    pages = paged.pages(spark, folder, Text, "*.txt", 1000)
    good, rejected, counts = paged.write_outcomes(pages, F.col("error"), f"{tmp_path}/out")
    assert len(os.listdir(f"{folder}-read")) == 505  # every page once
    assert counts == {"n": 506, "rejected": 2} and good.count() == 504 and good.columns == pages.columns
    assert sorted(r.reason for r in rejected.collect()) == ["KeyError: 'broken'", "ValueError: 1"] and len(os.listdir(f"{folder}-read")) == 505
    assert "outcome=good" in good._jdf.queryExecution().toString() or "PartitionFilters" in good._jdf.queryExecution().toString()
    nothing = paged.write_outcomes(pages.where("false"), F.col("error"), f"{tmp_path}/none")
    assert nothing[2] == {"n": 0, "rejected": 0} and nothing[0].count() == 0


def test_tables_of_answer_keys(spark, tmp_path):
    """Rows of all tables on marked pages without their heads, in the order of pages; a page that fails is a row."""
    (tmp_path / "keys").mkdir()
    page = "Answer Key\nh,h\n1,A\n2,B\n--\nh,h\n3,C"
    (tmp_path / "keys" / "a.txt").write_text(f"other\n9,Z\n8,Y\f{page}\fbad\fQuestion Alignment\nh\n4,D\n5,E")
    (tmp_path / "keys" / "b.txt").write_text("!")
    for task_bytes in (20, 10**6):
        rows = paged.answer_tables(spark, f"{tmp_path}/keys", Text, task_bytes=task_bytes).collect()
        got = [(r.page_number, r.cells) for r in sorted((r for r in rows if r.error is None), key=lambda r: r.row_ord)]
        assert got == [(2, ["1", "A"]), (2, ["2", "B"]), (2, ["3", "C"]), (4, ["5", "E"])]
        assert sorted((r.page_number or 0, r.error, r.cells) for r in rows if r.error) == [(0, "KeyError: 'broken'", None), (3, "ValueError: 2", None)]
