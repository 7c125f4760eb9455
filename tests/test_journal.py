"""Calls that are not made twice: broken runs, failed requests, images."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from quizloom.plans import workflows
from quizloom.sources import providers
from quizloom.sources.journal import Journal


def requests(spark, n):
    return providers.requests(spark.range(n).selectExpr("'s' AS system_prompt", "concat('u', id) AS user_prompt"))


def test_a_killed_run_sends_one_batch_again(spark, tmp_path):
    """A worker dies in the middle; the responses of the batches before stay, and the next run asks the rest and at most one batch again."""
    (tmp_path / "calls").mkdir()
    calls, alive = str(tmp_path / "calls"), str(tmp_path / "alive")

    def call(provider, system, user, settings):
        if not os.path.exists(alive) and len(os.listdir(calls)) >= 25:
            os._exit(1)
        open(os.path.join(calls, f"{user}-{uuid.uuid4().hex}"), "w").close()
        return user.upper()

    asked, path = requests(spark, 60), f"{tmp_path}/journal"
    with pytest.raises(Exception):  # noqa: B017, PT011  the stream's error names the dead worker
        providers.answers(asked, path, per_batch=10, call=call, tasks=2)
    before = {n.split("-")[0] for n in os.listdir(calls)}
    kept = Journal(spark, path, "request_id string, response string").done.read().count()
    assert 10 <= kept < 60 and len(before) - kept <= 10  # whole batches
    open(alive, "w").close()
    got = providers.answers(asked, path, per_batch=10, call=call, tasks=2)
    assert {r.response for r in got.collect()} == {f"U{i}" for i in range(60)}
    assert 60 <= len(os.listdir(calls)) <= 60 + 10
    n = len(os.listdir(calls))
    assert providers.answers(asked, path, per_batch=10, call=call).count() == 60 and len(os.listdir(calls)) == n
    assert providers.answers(requests(spark, 63), path, per_batch=10, call=call).count() == 63 and len(os.listdir(calls)) == n + 3


def test_batches_do_not_grow_with_the_requests(spark, tmp_path):
    """A long run has a bounded number of batches, and its tasks keep what they have when another one dies."""
    (tmp_path / "calls").mkdir()
    calls, alive = str(tmp_path / "calls"), str(tmp_path / "alive")

    def call(provider, system, user, settings):
        if not os.path.exists(alive) and len(os.listdir(calls)) >= 190:
            os._exit(1)
        open(os.path.join(calls, f"{user}-{uuid.uuid4().hex}"), "w").close()
        return user.upper()

    asked, path = requests(spark, 800), f"{tmp_path}/journal"
    with pytest.raises(Exception):  # noqa: B017, PT011  the stream's error names the dead worker
        providers.answers(asked, path, per_batch=20, call=call)
    n = len(os.listdir(calls))
    assert n >= 190
    open(alive, "w").close()
    got = providers.answers(asked, path, per_batch=20, call=call)
    assert {r.response for r in got.collect()} == {f"U{i}" for i in range(800)}
    assert len(os.listdir(calls)) <= 800 + 2 * 20  # batches have 100 requests
    assert len(Journal(spark, path, "request_id string, response string").done.versions()) <= 8 + 1
    assert os.listdir(f"{path}/log") == []


def test_failed_requests_are_asked_again(spark, tmp_path):
    path = f"{tmp_path}/journal"
    fails = lambda p, s, u, k: None if u == "u3" else "a"
    assert providers.answers(requests(spark, 9), path, per_batch=4, call=fails).count() == 8
    assert providers.answers(requests(spark, 9), path, per_batch=4, call=lambda p, s, u, k: "b").where("response = 'b'").count() == 1
    assert providers.answers(requests(spark, 0), path).count() == 0
    assert providers.answers(requests(spark, 9).union(requests(spark, 9)), path).count() == 9


def test_a_replayed_batch_counts_once(spark, tmp_path):
    """The stream's last batch is played again, as after a failure between the table and the checkpoint."""
    path = f"{tmp_path}/journal"
    calls = spark.sparkContext.accumulator(0)

    def call(provider, system, user, settings):
        calls.add(1)
        return "a"

    providers.answers(requests(spark, 8), path, per_batch=4, call=call)
    for name in ("1", ".1.crc"):
        os.remove(f"{path}/checkpoint/commits/{name}")
    assert providers.answers(requests(spark, 8), path, per_batch=4, call=call).count() == 8 and calls.value == 8


def test_images(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def call(provider, prompt, content):
        calls.add(1)
        if content == b"bad":
            raise ValueError(content)
        return f"**Extracted Question:** {prompt} {content.decode()}?\n---\n**Image Details:** red" if content != b"plain" else "no line"

    rows = [(1, b"one"), (2, b"one"), (3, b"bad"), (4, None), (5, b"plain"), (6, b"")]
    images = spark.createDataFrame(rows, "id int, content binary")
    for path in (None, f"{tmp_path}/journal", f"{tmp_path}/journal"):
        got = {r.id: (r.question, r.details) for r in workflows.image_questions(spark, images, "id", "content", prompt="P", call=call, responses=path).collect()}
        assert got == {1: ("P one?", "red"), 2: ("P one?", "red"), 3: (None, None), 4: (None, None), 5: ("no line", ""), 6: ("P ?", "red")}
    assert calls.value == 4 + 4 + 1  # equal images once, those with an answer in the journal not again
    assert workflows.image_questions(spark, images.limit(0), "id", "content").collect() == []
    one = providers.image_requests(images, "content", "P").where(F.col("id") == 1).first().request_id
    assert one != providers.image_requests(images, "content", "Q").where(F.col("id") == 1).first().request_id
