import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import AWKWARD, docs
from smogline.llm import pieces as P


@pytest.fixture(scope="module")
def vocabulary():
    return P.load()


@pytest.fixture(scope="module")
def lattice(vocabulary):
    return P.Lattice(vocabulary)


def plain(vocabulary, text, row_key, seed=P.SEED):
    """The same draws over lattices made character by character."""
    segments = P.SEGMENT.findall(" " + text)
    keys = P.segment_keys(np.array([row_key], dtype=np.uint64), np.array([len(segments)]), seed)
    out = []
    for segment, key in zip(segments, keys):
        forward, edges = [0.0], [None]
        for end in range(1, len(segment) + 1):
            here = []
            for size in range(1, min(end, 16) + 1):
                part = segment[end - size:end]
                if part in vocabulary.ids:
                    here.append((size, [vocabulary.ids[part]], vocabulary.weights[vocabulary.ids[part]]))
                elif size == 1:
                    here.append((1, [vocabulary.byte_ids[b] for b in part.encode()], vocabulary.weights.min() * 2))
            total = [forward[end - s] + w for s, _, w in here]
            forward.append(max(total) + math.log(sum(math.exp(t - max(total)) for t in total)))
            edges.append([(s, ids, math.exp(t - forward[end])) for (s, ids, _), t in zip(here, total)])
        at, step, own = len(segment), 0, []
        while at:
            u, summed = float(P.draws(np.array([key]), step)[0]), 0.0
            for size, ids, share in edges[at]:
                summed += share
                if u < summed:
                    break
            own = ids + own
            at, step = at - size, step + 1
        out += own
    return out


TEXTS = ["The quick brown fox", "a  b\n\n c ", "▁x", "é漢\U0001F600 z", " ", "\n", "internationalisation " * 3, "\x00\x01"]


def test_sampling_as_plain(vocabulary, lattice):
    keys = np.arange(len(TEXTS), dtype=np.uint64) * np.uint64(7919)
    got = lattice.encode(TEXTS, keys).to_pylist()
    assert got == [plain(vocabulary, t, k) for t, k in zip(TEXTS, keys)]


@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=8))
@settings(deadline=None, max_examples=150)
def test_decoding_is_lossless(vocabulary, lattice, texts):
    ids = lattice.encode(texts, np.arange(len(texts), dtype=np.uint64))
    assert P.decode_lists(vocabulary, ids) == texts


def test_a_row_is_cut_alike_in_any_batch(lattice, monkeypatch):
    keys = np.arange(len(TEXTS), dtype=np.uint64)
    whole = lattice.encode(TEXTS, keys).to_pylist()
    assert [lattice.encode([t], keys[i:i + 1]).to_pylist()[0] for i, t in enumerate(TEXTS)] == whole
    monkeypatch.setattr(P, "PART_CHARS", 5)
    assert lattice.encode(TEXTS, keys).to_pylist() == whole
    assert lattice.encode(TEXTS, keys, seed=1).to_pylist() != whole


@given(st.text(alphabet=" a\nb\0\t", max_size=30))
@settings(deadline=None, max_examples=500)
def test_segments_either_way(text):
    assert P.cut_segments(text) == P.SEGMENT.findall(text)


def test_samples_follow_the_weights(vocabulary, lattice):
    """Segmentations of a short word come as often as the product of their weights says."""
    word, n = " the", 20_000
    ids = vocabulary.ids

    def ways(rest):
        if not rest:
            return [((), 0.0)]
        return [((ids[rest[:k]], *tail), vocabulary.weights[ids[rest[:k]]] + w) for k in range(1, len(rest) + 1) if rest[:k] in ids
                for tail, w in ways(rest[k:])]
    known = dict(ways(word))
    total = sum(math.exp(w) for w in known.values())
    got = Counter(map(tuple, lattice.encode([word[1:]] * n, np.arange(n, dtype=np.uint64)).to_pylist()))
    assert set(got) <= set(known)
    for way, w in known.items():
        p = math.exp(w) / total
        assert abs(got[way] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 3


def test_long_words_and_texts(vocabulary, lattice):
    texts = ["x" * 30_000, "ab " * 200_000, " " * 50_000]
    assert P.decode_lists(vocabulary, lattice.encode(texts, np.arange(3, dtype=np.uint64))) == texts


def test_columns(spark):
    codec = P.Codec(spark)
    frame = docs(spark, AWKWARD * 2, [None, *range(1, len(AWKWARD))] * 2)
    done = P.decode(P.encode(frame.withColumnRenamed("key", "ids"), codec), codec)
    rows = done.collect()
    assert len(rows) == 2 * len(AWKWARD) and all(r["decoded"] == r["text"] for r in rows)
    again = {(r["doc_id"], r["text"]): r["ids"] for r in P.encode(frame.repartition(3), codec).collect()}
    assert all(again[(r["doc_id"], r["text"])] == r["ids"] for r in rows)
    assert all((r["ids"] is None) == (r["text"] is None) for r in rows)
    assert P.encode(docs(spark, []), codec).count() == 0


def test_segments_met_again_are_built_once(lattice, monkeypatch):
    """A wide part shares its lattices; one with many different segments is still cut as narrow as before."""
    built, build = [], lattice.build
    monkeypatch.setattr(P, "PART_CHARS", 60)
    monkeypatch.setattr(lattice, "build", lambda segments: (built.append(sum(map(len, segments))), build(segments)))
    keys = np.arange(4, dtype=np.uint64)
    lattice.encode(["one two three four five six"] * 4, keys)
    assert len(built) == 1
    built.clear()
    lattice.encode([" ".join(f"{i}x{j}y" for j in range(12)) for i in range(4)], keys)
    assert len(built) > 2 and max(built) <= 60


def test_round_trip_encodes_once(spark):
    """The query evaluates one function over the texts, not one for the ids and one more for what is decoded."""
    from smogline.llm.queries import op3_sentencepiece

    plan = op3_sentencepiece(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("run(") == 1


def test_round_trip_as_both(spark):
    codec = P.Codec(spark)
    frame = docs(spark, AWKWARD * 2, [None, *range(1, len(AWKWARD))] * 2)
    once, both = P.round_trip(frame, codec), P.decode(P.encode(frame, codec), codec)
    assert once.columns == both.columns and once.dtypes == both.dtypes
    assert sorted(map(str, once.collect())) == sorted(map(str, both.collect()))
    assert P.round_trip(docs(spark, []), codec).count() == 0


def test_memory_of_a_part(lattice):
    """Two workers of an executor each hold the edges of a part: few bytes an edge while it is built, fewer when it is done."""
    segments = [f" word{i} internationalisation{i}" for i in range(20_000)]
    tracemalloc.start()
    try:
        lattice.build(segments)
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert kept < 30 * len(lattice.piece) and peak < 95 * len(lattice.piece), (kept / len(lattice.piece), peak / len(lattice.piece))
