import math

import numpy as np
import pytest

from smogline.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, node string, code string, score string, anchor string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def brute(rows, every=100, k=5, low=80, high=100):
    sound = [(i, g, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, g in rows
             if g is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, g, v) in enumerate(sound):
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, h) for m, (j, h, w) in enumerate(sound) if m != n)
        for s, p, _ in [x for x in scored if x[2] == g][:k]:
            fit = [x for x in scored if x[2] != g and low * -s <= 100 * -x[0] <= high * -s][:k]
            out += [(i, p, r, q, -s, -t) for r, (t, q, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(rows, spark, **more):
    return sorted(tuple(r) for r in negatives.mine(frame(spark, rows), **more).collect())


def clouds(seed, n, dim, labels):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(4, dim))
    return [(i, [float(np.float32(x)) for x in middle[draw.integers(4)] + 0.4 * draw.normal(size=dim)], int(draw.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dim, labels", [(1, 2), (16, 3), (70, 10)])
def test_as_scoring_every_pair(spark, monkeypatch, dim, labels):
    monkeypatch.setattr(negatives, "ROWS", 150)
    monkeypatch.setattr(negatives, "ANCHORS", 20)
    monkeypatch.setattr(negatives, "STEP", 16)
    rows = clouds(dim, 600, dim, labels)
    assert mined(rows, spark, every=10) == brute(rows, every=10)


def test_intervals_hold_and_exclude():
    draw = np.random.default_rng(3)
    vectors = np.floor(256 * draw.normal(size=(500, 48))).astype(np.int64)
    codes, along, rest = negatives.encode(vectors)
    for query in [*vectors[:20], np.zeros(48, dtype=np.int64), np.full(48, 7)]:
        low, high = negatives.Query(query).interval(codes, along, rest)
        true = vectors @ query
        assert (low <= true).all() and (true <= high).all()
    low, high = negatives.Query(vectors[0]).interval(codes, along, rest)
    assert (high < vectors[0] @ vectors[0]).mean() > 0.9  # they tell most rows from the vector itself


def test_ties_zero_vectors_and_hot_label(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(120)] + [(i, [0.9, 0.1], i % 3) for i in range(120, 260)] + [
        (i, [0.0, 0.0], i % 2) for i in range(260, 320)] + [(i, [-1.0, -1.0], 1) for i in range(320, 402)]
    assert mined(rows, spark) == brute(rows)


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], None), (2, None, 1), (3, [None, 1.0], 1), (4, [float("nan"), 1.0], 2), (5, [float("inf"), 1.0], 2),
            (6, [], 1), (7, [1.0, 1.5], 1), (8, [1.0, 1.4], 2), (None, [1.0, 1.2], 2), (100, None, 1), (200, [1.0, 2.0], 3)]
    got = negatives.mine(frame(spark, rows)).collect()
    assert {r["anchor_id"] for r in got} == {0} and {r["positive_id"] for r in got} == {7}
    assert [(r["rank"], r["negative_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 8), (2, None)]
    assert mined([], spark) == [] and mined([(0, [1.0], 1)], spark) == []


def test_repeated_rows_count_once_and_lengths_do_not_meet(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.9], 2), (3, [1.0], 1)]
    assert mined(rows * 2, spark) == mined(rows, spark) == brute(rows[:3])


def test_whole_numbers_beyond_doubles():
    big = np.array([[1 << 40, 3], [1 << 40, 4]])
    assert negatives.scores(big, np.array([1 << 20, 1])).tolist() == [(1 << 60) + 3, (1 << 60) + 4]
    assert negatives.scores(big, np.array([1 << 40, 1])).tolist() == [(1 << 63) - 1] * 2
