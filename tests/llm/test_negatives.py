"""Hard negatives against a plain search, and the bounds against exact scores."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quizloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score int"


def plain(rows, anchors, positives=5, negatives=3, percent=(50, 95)):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all():
            own = (label, [int(x) for x in np.floor(256 * np.array(v))])
            good[i] = min(good.get(i, own), own)
    out = []
    for a, (label, x) in good.items():
        if not anchors(a):
            continue
        scores = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for i, (other, y) in good.items() if i != a and len(x) == len(y)]
        for p, pid, _ in sorted(s for s in scores if s[2] == label)[:positives]:
            found = sorted((s, i) for s, i, other in scores if other != label and percent[0] * -p <= 100 * -s <= percent[1] * -p)[:negatives]
            out += [(a, pid, n + 1, i, -p, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def rows_of(seed, n=700, dim=10, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    v = (centre[label] * 0.5 + rng.normal(size=(n, dim))) / 3
    return [(i, [float(x) for x in r], int(k)) for i, (r, k) in enumerate(zip(v, label, strict=True))]


@pytest.mark.parametrize("shape", ["plain", "ties", "odd"])
def test_mine(spark, shape):
    rows = rows_of(1)
    if shape == "ties":  # a third of all vectors are one, of all labels
        rows = [(i, rows[0][1] if i % 3 == 0 else v, k) for i, v, k in rows]
    if shape == "odd":
        rows += [(900, None, 1), (910, [1.0, None], 1), (920, [float("nan")] * 10, 2), (930, [float("inf")] * 10, 2), (940, rows[0][1], None), (None, rows[1][1], 1), (950, [], 1), (960, [0.5, -0.25], 1), (970, [0.25, 0.5], 1), (980, [0.2, 0.1], 2), (990, [0.5, 0.25], 1)]
        rows += [(i, v, (k + 1) % 4) for i, v, k in rows[:60]] + rows[:30] + [(1000, [1e6] * 10, 1), (1010, [0.0] * 10, 1)]
    df = spark.createDataFrame([(*r, "r", 1) for r in rows], SCHEMA).repartition(3)
    for block, chunk in ((100, 16), (4096, None)):
        got = hard_negatives.mine(df, lambda i: i % 10 == 0, block=block, chunk=chunk, sample_rows=256)
        assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 10 == 0)
    assert len(plain(rows, lambda i: i % 10 == 0)) > 200
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_few_and_none(spark):
    df = spark.createDataFrame([(10, [1.0, 0.0], 1, "r", 1), (11, [0.9, 0.0], 1, "r", 1), (12, [0.8, 0.1], 2, "r", 1)], SCHEMA)
    assert [tuple(r) for r in hard_negatives.mine(df, lambda i: i % 10 == 0).collect()] == [(10, 11, 1, 12, 230 * 256, 204 * 256)]
    assert hard_negatives.mine(df.limit(0), lambda i: i % 10 == 0).collect() == []
    assert hard_negatives.mine(df, lambda i: i > 99).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 11), st.integers(0, 10**6), st.sampled_from([3, 300, 10**7]))
def test_bounds_hold(n, dim, seed, size):
    rng = np.random.default_rng(seed)
    rows, anchors = rng.integers(-size, size + 1, (n, dim)), rng.integers(-size, size + 1, (7, dim))
    for books in (hard_negatives.fit(rows[: n // 2 + 1]), hard_negatives.books_for({}, dim)):
        low, high = hard_negatives.bounds(anchors, books, *hard_negatives.encode(rows, books))
        exact = anchors @ rows.T
        assert (low <= exact).all() and (exact <= high).all()


def test_bounds_spare_most_rows():
    """On clustered vectors few rows are scored exactly."""
    rows = rows_of(3, 4000, 16, 8)
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    books = hard_negatives.fit(v[:2000])
    low, high = hard_negatives.bounds(v[:50], books, *hard_negatives.encode(v, books))
    left = [(hi >= hard_negatives.kth_largest(lo, 5)).sum() for lo, hi in zip(low, high, strict=True)]
    assert np.mean(left) < 0.05 * len(v)
