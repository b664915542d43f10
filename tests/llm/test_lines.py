import random

import numpy as np
import pytest

from cases import AWKWARD, LONG, docs
from smogline.llm.cuckoo import Cuckoo
from smogline.llm.lines import LineIndex

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    return line if len(line) >= 20 else None


def brute(rows, indexed=None):
    holders = {}
    for i, t in indexed or rows:
        for line in (t or "").split("\n"):
            if key(line) and i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or not key(x) or len(holders.get(key(x), ())) < 3 or i == max(holders[key(x)])]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect()), key=str)


def sample(n=80, seed=6):
    rng = random.Random(seed)
    shared = [f"Shared passage number {i} of several" for i in range(12)] + ["nineteen characters", "twenty chars exactly", "é" * 20]
    texts = []
    for i in range(n):
        lines = [rng.choice(["  ", "\t", ""]) + rng.choice([s, s.upper()]) + rng.choice(["\r", ""]) for s in rng.sample(shared, 3)]
        texts.append("\n".join(lines + [f"Only in the document number {i}"] + lines[:1] * (i % 2)))
    return texts


def test_cuckoo_filter():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 256, (20_000, 16), dtype=np.uint8)
    made = Cuckoo.built(keys)
    assert made.contains(keys).all()
    others = rng.integers(0, 256, (20_000, 16), dtype=np.uint8)
    assert made.contains(others).mean() < 0.002
    made.remove(keys[:10_000])
    assert made.contains(keys[10_000:]).all() and made.contains(keys[:10_000]).mean() < 0.01
    again = Cuckoo.load(made.dump())
    assert again.add(keys[:10_000]) and again.contains(keys).all()
    assert len(Cuckoo.built(keys[:0]).contains(keys[:0])) == 0
    with pytest.raises(KeyError):
        Cuckoo.sized(4).remove(keys[:1])
    assert not Cuckoo(np.zeros((2, 4), dtype=np.uint16)).add(keys[:100])


@pytest.mark.parametrize("filter_bytes", [1 << 26, -1])
def test_dedup_as_brute_force(spark, shared, filter_bytes):
    """With filters and, beyond their limit, without: equal results."""
    texts = sample() + AWKWARD + [LONG + "\n" + "Shared passage number 1 of several"]
    ids = [None if i == 5 else 3 if i == 9 else 200 - i for i in range(len(texts))]
    frame = docs(spark, texts, ids)
    index = LineIndex(spark, shared("lines"))
    index.insert(frame)
    done = index.dedup(frame, filter_bytes=filter_bytes)
    assert done.columns == [*frame.columns, "n_dropped"]  # the frame has a column n_lines of its own
    assert result(done) == brute(list(zip(ids, texts)))


def test_insertions_and_deletions_are_reversible(spark, shared):
    texts = sample(60, 8)
    rows = list(enumerate(texts))
    first, second = docs(spark, texts[:40]), docs(spark, texts[40:], range(40, 60))
    path = shared("lines")
    index = LineIndex(spark, path)
    index.insert(first)
    before = sorted(map(tuple, index.counts().collect()))
    index.insert(second)
    index.insert(second)  # again: counts once
    whole = docs(spark, texts)
    assert result(index.dedup(whole)) == brute(rows)
    index = LineIndex.open(spark, path)
    index.delete(spark.createDataFrame([(i,) for i in [*range(40, 60), 999, None]], "doc_id long"))
    assert sorted(map(tuple, index.counts().collect())) == before
    assert result(index.dedup(first)) == brute(rows[:40])
    index.delete(spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long"))
    assert result(index.dedup(first)) == brute(rows[:40], rows[1:40:2])
    index.insert(docs(spark, texts[:40:2], range(0, 40, 2)))
    assert result(index.dedup(first)) == brute(rows[:40])


def test_empty(spark, shared):
    index = LineIndex(spark, shared("lines"))
    index.insert(docs(spark, []))
    assert index.dedup(docs(spark, [])).count() == 0
    frame = docs(spark, ["", None])
    assert result(index.dedup(frame)) == brute([(0, ""), (1, None)])
