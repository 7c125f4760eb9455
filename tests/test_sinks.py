"""Deliveries to several sinks that fail for some groups or break off in between; outcomes counted as they are written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quizloom.sources.sinks import Delivery, Sink
from quizloom.sources.store import Files


def line(row):
    if row["v"] == "bad":
        raise ValueError(row["k"])
    return f"{row['k']}"


def whole(row):
    return f"{row['k']}:{row['v']}"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "x", "a"), (2, "bad", "a"), (3, "y", "b"), (4, "z", None), (5, "y", "b")], "k int, v string, g string")


def delivery(spark, tmp_path, *encoders):
    sinks = [Sink(f"s{k}", f"{tmp_path}/s{k}", e) for k, e in enumerate(encoders)]
    for s in sinks:
        Files(spark, s.path).system.mkdirs(Files(spark, s.path).at(""))
    return Delivery(spark, f"{tmp_path}/status", sinks)


def kept(spark, sink):
    return sorted(r.value for r in spark.read.schema("value string, grp string").text(f"{sink.path}/run=r").select("value").collect())


def test_partial_success(spark, tmp_path, rows):
    d = delivery(spark, tmp_path, line, whole)
    got = {(r.sink, r.grp): (r.status, r.error, r.n) for r in d.run("r", rows, "g").collect()}
    assert got == {("s0", "a"): ("failed", "ValueError: 2", 2), ("s0", "b"): ("saved", None, 2), ("s0", ""): ("saved", None, 1)} | {("s1", g): ("saved", None, n) for g, n in (("a", 2), ("b", 2), ("", 1))}
    assert kept(spark, d.sinks[0]) == ["3", "4", "5"] and kept(spark, d.sinks[1]) == ["1:x", "2:bad", "3:y", "4:z", "5:y"]
    assert {r.grp: r.success for r in d.outcome("r").collect()} == {"a": True, "b": True, "": True}
    one = delivery(spark, tmp_path / "one", line)
    one.run("r", rows, "g")
    assert {r.grp: r.success for r in one.outcome("r").collect()} == {"a": False, "b": True, "": True}
    again = {(r.sink, r.grp): r.status for r in d.run("r", rows.union(rows), "g").collect()}  # a run counts once
    assert again == {k: v[0] for k, v in got.items()} and kept(spark, d.sinks[0]) == ["3", "4", "5"]
    assert delivery(spark, tmp_path / "none", line).run("r", rows.limit(0), "g").collect() == []


@pytest.mark.parametrize("at", ["record", "rename", "status"])
def test_a_broken_run_is_finished(spark, tmp_path, rows, monkeypatch, at):
    d = delivery(spark, tmp_path, whole, line)

    def lost(*a, **k):
        raise RuntimeError("lost")

    target, name = {"record": (d.status, "insert"), "rename": (Files, "move"), "status": (d.status, "update")}[at]
    real = getattr(target, name)
    monkeypatch.setattr(target, name, (lambda self, *a: lost() if a[0].startswith(".staged") else real(self, *a)) if at == "rename" else lost)
    with pytest.raises(RuntimeError):
        d.run("r", rows, "g")
    monkeypatch.undo()
    fresh = Delivery(spark, f"{tmp_path}/status", d.sinks)
    fresh.recover("r")
    first = Files(spark, d.sinks[0].path).names("")
    assert first == ([] if at == "record" else ["run=r"])  # removed, or finished
    got = {(r.sink, r.grp): r.status for r in fresh.run("r", rows, "g").collect()}
    assert got == {("s0", g): "saved" for g in ("a", "b", "")} | {("s1", "a"): "failed", ("s1", "b"): "saved", ("s1", ""): "saved"}
    assert kept(spark, d.sinks[0]) == ["1:x", "2:bad", "3:y", "4:z", "5:y"] and kept(spark, d.sinks[1]) == ["3", "4", "5"]
    assert all(not n.startswith(".staged") for s in d.sinks for n in Files(spark, s.path).names(""))
