import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cases import AWKWARD, docs
from smogline.llm import exact


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    out = []
    for key, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        out += [(i, best, len(ids), i == best, hashlib.sha256(key).hexdigest()) for i in ids]
    return sorted(out, key=str)


@given(st.lists(st.binary(max_size=6), max_size=60), st.sampled_from([1 << 30, 700]))
@settings(deadline=None, max_examples=200)
def test_trie_holds_what_went_in(keys, limit):
    """With a small limit subtrees are spilled, and the result is the same."""
    trie, want = exact.Patricia(limit), {}
    for i, k in enumerate(keys):
        trie.add(k, i % 7)
        low, n = want.get(k, (99, 0))
        want[k] = (min(low, i % 7), n + 1)
    found = list(trie.items())
    assert len(found) == len(want) and {k: (o, n) for k, o, n in found} == want


def test_long_common_prefixes():
    keys = [b"p" * n + t for n in (0, 4095, 4096, 4097, 9000) for t in (b"", b"a", b"b")]
    trie = exact.Patricia(20_000)
    for i, k in enumerate(keys * 2):
        trie.add(k, i)
    assert {k: n for k, _, n in trie.items()} == {k: 2 for k in keys}


def test_long_strings_beyond_the_limit():
    header = b"h" * 3000
    for limit, keys in ((1000, [b"x" * 5000]), (1000, [b"x" * 5000, b"x" * 4999 + b"y", b"x" * 4999]),
                        (100_000, [header + str(i).encode() * 3 for i in range(400)]), (500, [b"n" * i for i in range(300)])):
        trie = exact.Patricia(limit)
        for i, k in enumerate(keys * 2):
            trie.add(k, i)
        found = list(trie.items())
        assert len(found) == len(keys) and {k: (o, n) for k, o, n in found} == {k: (i, 2) for i, k in enumerate(keys)}


def test_dedup_as_brute_force(spark):
    rng = random.Random(3)
    texts = AWKWARD + [rng.choice(["Same", "same", "SAME ", "a" * 100, "ÉA", "éa"]) for _ in range(200)]
    ids = [rng.choice([None, rng.randint(0, 150)]) if i % 10 == 0 else i for i in range(len(texts))]
    frame = docs(spark, texts, ids).repartition(5)
    for keep in ("smallest", "largest"):
        got = sorted((tuple(r) for r in exact.dedup(frame, keep=keep).collect()), key=str)
        assert got == brute(zip(ids, texts), keep)


def test_small_tries_give_the_same(spark):
    texts = [f"text {i % 40} " + "y" * (i % 40) for i in range(300)]
    got = exact.owners(docs(spark, texts), trie_bytes=2000)
    assert sorted((r["keep_id"], r["group_size"]) for r in got.collect()) == sorted((i, len(range(i, 300, 40))) for i in range(40))


def test_empty(spark):
    assert exact.dedup(docs(spark, [])).count() == 0
