import random
import zlib

import numpy as np

from cases import AWKWARD, docs
from smogline.llm import langid, quality

FOLDER = "/root/testdata/sf0.01"


def test_counts_in_parts_equal_counts_at_once(monkeypatch):
    texts = ["Ab cd  e!fg h", "é漢" * 40, "a" * 7 + " 1 " + "b c" * 9, "x"]
    whole = [langid.counts(t) for t in texts]
    monkeypatch.setattr(langid, "PART_CHARS", 3)
    assert all((langid.counts(t) == w).all() for t, w in zip(texts, whole))
    assert langid.counts("12 .") is None and langid.counts("") is None and langid.counts(None) is None


def test_clusters_are_found():
    rng = np.random.default_rng(11)
    centres = np.eye(3, 50)
    own = rng.integers(0, 3, 200)
    x = centres[own] + 0.05 * rng.standard_normal((200, 50))
    x /= np.linalg.norm(x, axis=1)[:, None]
    found, named = langid.cluster(x, 3)
    assert len(set(zip(own.tolist(), named.tolist()))) == 3 and (x * found[named]).sum(axis=1).min() > 0.8


def test_held_out_accuracy_and_rejection(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.fit(table)
    rows = langid.identify(table, model).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98
    assert sum(r["rejected"] for r in rows) == 0  # clean texts stay
    odd = docs(spark, AWKWARD + ["Москва слезам не верит и никогда не верила этим людям", "1234 5678"])
    found = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert len(found) == len(AWKWARD) + 2
    for i, t in enumerate(AWKWARD + [None, "1"]):
        if i < len(AWKWARD):
            assert (found[i]["lang_pred"] == "und") == (t is None or not any(c.isalpha() for c in t))
    assert found[len(AWKWARD)]["rejected"] and found[len(AWKWARD) + 1]["lang_pred"] == "und"
    kept = langid.accept(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["rejected"]}


def test_labels_that_teach_nothing(spark):
    for frame in (docs(spark, []), docs(spark, ["some text"], [4], lang=None)):
        model = langid.fit(frame)
        assert model.languages == []
        assert {r["lang_pred"] for r in langid.identify(frame, model).collect()} <= {"und"}
        assert langid.accept(frame, model).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(12)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone, both = quality.train(x[:3000], y[:3000], rounds=40, pairs=0), quality.train(x[:3000], y[:3000], rounds=120, pairs=2)
    right = lambda m: ((m.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean()
    assert right(alone) < 0.65 and right(both) > 0.95
    # a score is the sum of the bins' values, nothing else
    at, i = both.bins(x[:5]), 2
    by_hand = both.base + sum(t[at[i, f]] for f, t in enumerate(both.tables)) + sum(t[at[i, a], at[i, b]] for a, b, t in both.pairs)
    assert abs(by_hand - both.logits(x[:5])[i]) < 1e-9


def test_trees_cut_where_it_helps():
    gradient, weight = np.array([5.0, 5, -5, -5, 0, 0]), np.ones(6)
    tree = quality._tree(gradient, weight)
    assert tree[0] == tree[1] > 0 > tree[2] == tree[3] and tree[4] == tree[5]
    gain, grid = quality._quadrants(np.array([[3.0, -3], [-3, 3]]), np.ones((2, 2)))
    assert gain > 0 and (np.sign(grid) == [[1, -1], [-1, 1]]).all()


def test_quality_held_out_and_awkward(spark):
    table, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.fit(table, labels)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.score(table, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    out = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in out]) > 0.95
    odd = docs(spark, AWKWARD * 2, [None, *range(1, 2 * len(AWKWARD))])
    again = quality.score(odd, model).collect()
    by_text = {}
    for r, t in zip(sorted(again, key=lambda r: r["doc_id"] or 0), AWKWARD * 2):
        by_text.setdefault(t or "", set()).add(r["score"])
    assert len(again) == 2 * len(AWKWARD) and all(len(s) == 1 for s in by_text.values())
    assert quality.score(docs(spark, []), model).count() == 0


def test_quality_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = docs(spark, ["one", "two", None])
    assert len({r["score"] for r in quality.score(frame, quality.fit(frame, empty)).collect()}) == 1
    odd = spark.createDataFrame([(0, None), (1, 7), (None, 1), (1, 1), (1, 0)], "doc_id long, quality int")
    quality.fit(frame, odd)
