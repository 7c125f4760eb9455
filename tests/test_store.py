"""Keyed tables with versions, and the state of seen keys with its filter."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from quizloom.sources.seen import MASK_BITS, WORDS, SeenState
from quizloom.sources.store import Conflict, Store

SCHEMA = "id bigint, v string, n int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def content(store, version=None):
    return {r.id: (r.v, r.n) for r in store.read(version).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return Store.open(spark, f"{tmp_path}/table", SCHEMA, "id", 8)


def commits(manifest):
    return {b: set(c) for b, c in manifest.files.items()}


def test_versions(spark, store):
    assert store.read().count() == 0 and store.versions() == [0]
    store.upsert(rows(spark, *[(i, "a", 0) for i in range(100)]))
    assert store.upsert(rows(spark)).version == 1  # no rows, no version
    again = Store.open(spark, store.path, SCHEMA, "id")
    assert again.manifest().buckets == 8 and again.upsert(rows(spark, (3, "b", 1), (100, "b", 1), (None, "b", 1))).version == 2
    assert content(store) == {i: ("a", 0) for i in range(100)} | {3: ("b", 1), 100: ("b", 1)} and len(content(store, 1)) == 100 and store.manifest().rows == 101
    with pytest.raises(ValueError, match="no version"):
        store.read(7)
    with pytest.raises(ValueError, match="has the key"):
        Store.open(spark, store.path, SCHEMA, "v")


def test_changes_write_their_buckets_only(spark, store):
    first = store.upsert(rows(spark, *[(i, "a", 0) for i in range(400)]))
    second = store.upsert(rows(spark, (5, "b", 1)))
    changed = {b for b in commits(second) if commits(first).get(b) != commits(second)[b]}
    assert len(changed) == 1 and len(first.files) == 8
    third = store.insert(rows(spark, (5, "c", 2), (1000, "c", 2), (1000, "d", 1)))
    added = {b: commits(third)[b] - commits(second)[b] for b in commits(third) if commits(third)[b] != commits(second)[b]}
    assert len(added) == 1 and all(commits(second)[b] < commits(third)[b] for b in added)  # beside the files that were there
    assert content(store)[1000] == ("c", 2) and content(store)[5] == ("b", 1)  # of repeated keys the smallest row
    assert store.insert(rows(spark, (5, "x", 0))).version == 3
    fourth = store.update(rows(spark, (5, "z", 9), (7777, "z", 9)), ["v"])
    assert content(store)[5] == ("z", 1) and 7777 not in content(store) and fourth.rows == 401
    assert store.update(rows(spark, (7777, "z", 9)), ["v"]).version == 4
    assert store.delete(rows(spark, (5, "", 0), (6, "", 0), (9999, "", 0))).rows == 399 and {5, 6} & set(content(store)) == set()
    assert len(content(store, 1)) == 400 and store.vacuum(2) > 0 and store.versions() == [4, 5] and len(content(store)) == 399
    with pytest.raises(ValueError):
        store.read(1)


def test_repeated_keys(spark, store):
    """A third of all rows has one key; the last by an order stays, and among equals the greatest."""
    many = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS id", "concat('v', id % 10) AS v", "CAST(id % 100 AS INT) AS n")
    store.upsert(many, order="n")
    assert content(store)[7] == ("v9", 99) and store.manifest().rows == many.select("id").distinct().count()
    store.upsert(rows(spark, (7, "b", 1), (7, "c", 1), (7, "a", 0)), order="n")
    assert content(store)[7] == ("c", 1)


def test_a_batch_counts_once(spark, store):
    for _ in range(2):
        store.upsert(rows(spark, (1, "a", 0)), batch=("stream", 0))
    store.upsert(rows(spark, (1, "b", 0)), batch=("stream", 1))
    assert store.upsert(rows(spark, (1, "late", 0)), batch=("stream", 0)).version == 2 and content(store)[1] == ("b", 0)


def test_two_writers(spark, store, monkeypatch):
    """A writer that comes second makes its change over the first one's; if they touch other buckets, what it wrote is kept."""
    store.upsert(rows(spark, *[(i, "a", 0) for i in range(50)]))
    bucket = {r.id: r.b for r in spark.range(50).select("id", F.pmod(F.xxhash64("id"), F.lit(8)).alias("b")).collect()}
    apart = next(i for i in range(50) if bucket[i] != bucket[0])
    for other, writes in ((apart, 1), (0, 2)):
        rival, written, publish = Store(spark, store.path), [], Store._publish
        write = Store._write

        def late(self, m, rival=rival, other=other, publish=publish):
            if self is store and not late.came:
                late.came = True
                rival.upsert(rows(spark, (other, "rival", 1)))
            return publish(self, m)

        def count(self, r, m, written=written, write=write):
            written.append(self is store)
            return write(self, r, m)

        late.came = False
        monkeypatch.setattr(Store, "_publish", late)
        monkeypatch.setattr(Store, "_write", count)
        store.upsert(rows(spark, (0, f"mine {other}", 2)))
        monkeypatch.undo()
        got = content(store)
        assert got[0] == (f"mine {other}", 2) and got[apart][0] == "rival" and len(got) == 50 and sum(written) == writes


def test_writers_at_once(spark, store):
    """Each of five threads adds rows and takes some away from the same buckets; no change is lost."""
    failed = []

    def work(k):
        try:
            own = Store(spark, store.path)
            own.upsert(rows(spark, *[(100 * k + i, "a", k) for i in range(10)]))
            own.delete(rows(spark, (100 * k, "", 0)))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and set(content(store)) == {100 * k + i for k in range(5) for i in range(1, 10)}
    assert store.versions() == list(range(11)) and store.manifest().rows == 45


def test_gives_up(spark, store, monkeypatch):
    monkeypatch.setattr(Store, "_publish", lambda self, m: False)
    with pytest.raises(Conflict):
        store.upsert(rows(spark, (1, "a", 0)))
    monkeypatch.undo()
    assert store.versions() == [0]


def keys(spark, a, b):
    return spark.range(a, b).select(F.sha2(F.col("id").cast("string"), 256).alias("hash"))


def test_seen_state(spark, tmp_path):
    state = SeenState(spark, f"{tmp_path}/seen", buckets=4, expected=8000)
    assert state.add(keys(spark, 0, 3000)) == 3000 and state.add(keys(spark, 2000, 5000)) == 2000 and state.add(keys(spark, 0, 5000)) == 0
    assert state.keys.versions() == [0, 1, 2] and state.read().count() == 5000
    # no key is missed; of keys that are not there few pass the filter, and the exact join stops those
    assert state.possible(keys(spark, 0, 5000)).count() == 5000
    false = state.possible(keys(spark, 10_000, 60_000)).count()
    assert 0 < false < 0.01 * 50_000 and state.unseen(keys(spark, 10_000, 60_000)).count() == 50_000
    some = keys(spark, 4990, 5010).union(keys(spark, 4990, 5010)).withColumn("word", F.lit("x")).union(spark.createDataFrame([(None, "y")], "hash string, word string"))
    assert state.unseen(some).count() == 21 and SeenState(spark, f"{tmp_path}/seen").unseen(some).columns == ["hash", "word"]


def test_filter_grows(spark, tmp_path):
    state = SeenState(spark, f"{tmp_path}/seen", buckets=4, expected=64)
    words = state.filter.manifest().properties[WORDS]
    state.add(keys(spark, 0, 300))
    state.add(keys(spark, 0, 2000))
    assert state.filter.manifest().properties[WORDS] == 8 * words and MASK_BITS == 4
    assert state.possible(keys(spark, 0, 2000)).count() == 2000 and state.possible(keys(spark, 5000, 15_000)).count() < 300


def test_filter_before_state(spark, tmp_path, monkeypatch):
    """A run that fails between filter and state has added nothing; the next one adds all."""
    state = SeenState(spark, f"{tmp_path}/seen", buckets=4, expected=1000)
    state.add(keys(spark, 0, 10))

    def fails(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(state.keys, "insert", fails)
    with pytest.raises(RuntimeError):
        state.add(keys(spark, 5, 20))
    monkeypatch.undo()
    assert state.unseen(keys(spark, 0, 20)).count() == 10 and state.add(keys(spark, 5, 20)) == 10


def test_streams_into_tables(spark, tmp_path):
    """Batches of a stream go to a keyed table and to a state of seen keys; batches that are played again count once."""
    from quizloom.streaming import store_batches, unseen_batches

    source, schema = f"{tmp_path}/in", "id bigint, hash string, n int"
    for k in range(3):
        spark.range(10 * k, 10 * k + 15).selectExpr("id", "concat('h', id % 20) AS hash", f"{k} AS n").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    for name, write in (("table", store_batches(f"{tmp_path}/table", "id", order="n")), ("unseen", unseen_batches(f"{tmp_path}/seen", f"{tmp_path}/unseen"))):
        for again in range(2):
            if again:  # the last batch has no commit, as after a failure
                for f in ("2", ".2.crc"):
                    (tmp_path / f"cp-{name}" / "commits" / f).unlink()
            stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/cp-{name}").trigger(availableNow=True).start().awaitTermination(120)
    table = Store(spark, f"{tmp_path}/table")
    assert {r.id: r.n for r in table.read().collect()} == {i: min(i // 10, 2) for i in range(35)} and table.versions() == [0, 1, 2, 3]
    unseen = Store(spark, f"{tmp_path}/unseen").read().collect()
    assert sorted(r.hash for r in unseen) == sorted(f"h{i}" for i in range(20)) and SeenState(spark, f"{tmp_path}/seen").read().count() == 20


def test_extracted_questions_replace_their_like(spark, tmp_path):
    from quizloom.plans import workflows

    pages = spark.createDataFrame([("d", 1, "Question 7 see Figure 1"), ("d", 2, "Question 8")], "doc string, page_number int, text string")
    key = spark.createDataFrame([("d", 1, ["7", "B", "s", "lo", "2"])], "doc string, row_ord int, cells array<string>")
    out = f"{tmp_path}/vectors"
    first = workflows.extract(spark, pages, key, "T", out=out).collect()
    again = workflows.extract(spark, pages.where("page_number = 1").withColumn("text", F.lit("Question 7 anew")), key, "T", out=out).collect()
    stored = {r.question_id: r for r in Store(spark, out).read().collect()}
    assert len(stored) == len(first) and all(stored[r.question_id].question == r.question and len(r.embedding) == 16 for r in again)
    assert {r.question for r in again} != {r.question for r in first if r.page_number == 1} and Store(spark, out).versions() == [0, 1, 2]


def test_exams_over_one_state(spark, tmp_path):
    import json

    from quizloom.plans import workflows

    units = spark.createDataFrame([(1, "Limits", 50.0, ["a"]), (2, "Series", 50.0, ["b"])], "unit_id int, unit string, weight double, objectives array<string>")
    call = lambda p, s, u, k: json.dumps({"questions": [{"question": f"{u.split()[6]} {i}"} for i in range(int(k["num_questions"]))]})
    state = SeenState(spark, f"{tmp_path}/state", buckets=4)
    sizes = [workflows.exam(spark, units, "Maths", total, "2024-01-02 03:04:05", seen=state, call=call).count() for total in (4, 10, 10)]
    assert sizes == [4, 6, 0] and state.read().count() == 10


def test_keys_of_another_type(spark, store, tmp_path):
    """A key is the same in a narrower type, and columns that the table has not are left out."""
    store.upsert(rows(spark, *[(i, "a", 0) for i in range(40)]))
    narrow = spark.range(30, 50).selectExpr("CAST(id AS SMALLINT) AS id", "'b' AS v", "CAST(1 AS TINYINT) AS n", "'more' AS more")
    store.upsert(narrow)
    assert content(store) == {i: ("a", 0) if i < 30 else ("b", 1) for i in range(50)} and store.manifest().rows == 50
    assert store.insert(narrow).version == 2 and store.delete(narrow).rows == 30
    state = SeenState(spark, f"{tmp_path}/seen", "id", "bigint", 4)
    assert state.add(spark.range(20)) == 20 and state.add(narrow.selectExpr("CAST(id - 20 AS INT) AS id")) == 10 and state.unseen(narrow.selectExpr("CAST(id - 25 AS INT) AS id")).count() == 0
