import numpy as np
import pytest

from smogline.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, key string, node long, cell string"


def brute(rows, threshold=0.98):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) and label is not None for _, v, label in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    place = lambda i: 1 << 62 if rows[i][0] is None else rows[i][0]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    x, y = sorted((find(i), find(j)), key=place)
                    root[y] = x
    return sorted(((rows[i][0], links[i], rows[find(i)][0], rows[i][0] == rows[find(i)][0]) for i in range(len(rows))), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(13)
    out = []
    for i in range(12):
        centre = rng.standard_normal(24)
        out += [(centre + s * rng.standard_normal(24)).tolist() for s in np.linspace(0.01, 0.3, 14)]
    out = [(i, v, i % 2) for i, v in enumerate(out)]
    hot = rng.standard_normal(24).tolist()
    out += [(1000 + i, hot, 1) for i in range(60)] + [(2000 + i, [x * (1 + i % 2) for x in hot], 0) for i in range(7)]
    nan, inf = float("nan"), float("inf")
    out += [(3000, [nan] * 24, 1), (3001, None, 1), (3002, [0.0] * 24, 1), (3003, hot, None), (3004, [], 1), (3005, [1.0, 2.0], 1),
            (3006, [2.0, 4.0], 1), (3007, [1.0, None], 1), (3008, [inf, 1.0], 1), (None, hot, 1), (1000, hot, 1), (3009, [-1.0, -2.0], 1)]
    return out


@pytest.mark.parametrize("cell_rows, homes, visitors", [(2048, 2048, 16384), (10, 2048, 16384), (3, 4, 8)])
def test_dedup_as_brute_force(spark, monkeypatch, rows, cell_rows, homes, visitors):
    """One cell, many cells, and cells dealt in tiny tiles: the same links."""
    monkeypatch.setattr(E, "HOMES", homes)
    monkeypatch.setattr(E, "VISITORS", visitors)
    frame = spark.createDataFrame([(*r, "k", 1, "c") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in E.dedup(frame, cell_rows=cell_rows).collect()), key=str)
    assert got == brute(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(14)
    a, b = rng.standard_normal(48), rng.standard_normal(48)
    a, b = a / np.linalg.norm(a), (a + 0.7 * b / np.linalg.norm(b))
    b /= np.linalg.norm(b)
    found = []
    for seed in range(400):
        turn = E.rotation(48, seed)
        packed, factor = E.codes((a @ turn)[None])
        estimate, bound = E.estimates(packed, factor, (b @ turn)[None])
        assert bound[0, 0] >= a @ b - 1e-6
        found.append(estimate[0, 0])
    assert abs(np.mean(found) - a @ b) < 4 * np.std(found) / 20


def test_empty(spark):
    assert E.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
