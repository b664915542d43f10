import random
import re

import xxhash

from cases import AWKWARD, docs
from smogline.llm import simhash
from smogline.llm.graph import components


def plain(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, own in enumerate(ids):
        k = find(i)
        known = [x for x in (least.get(k), own) if x is not None]
        least[k] = min(known) if known else None
    return [least[find(i)] for i in range(len(ids))]


def test_fingerprint_is_the_plain_one():
    for text in [*AWKWARD, "One two THREE four", "one two", "r r r r r r r"]:
        assert simhash.fingerprint(None if text is None else text.encode()) == plain(text)


def test_groups_as_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(6)]
    texts = list(AWKWARD)
    for i in range(150):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    ids = [None if i == 20 else 7 if i in (30, 31) else 1000 - i for i in range(len(texts))]
    want = sorted(zip(ids, map(plain, texts), groups(ids, list(map(plain, texts)))), key=str)
    frame = docs(spark, texts, ids)
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.groups(frame).collect()), key=str)
    assert got == want
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    stays = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in stays if i is not None) == sorted({c for i, _, c in want if i == c and c is not None}) and stays.count(None) == 1


def test_links_when_blocks_are_crowded(spark):
    """Bucket limits that force every level of splitting connect the same prints."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints)[:10]:
        for _ in range(30):
            prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    want = groups(prints, prints)
    for crowded in (4096, 10, 1):
        found = {r["node"] % (1 << 64): r["component"] for r in components(simhash.links(frame, crowded=crowded)).collect()}
        got = [found.get(p, p - (1 << 64) if p >> 63 else p) for p in prints]
        assert [got.index(g) for g in got] == [want.index(w) for w in want]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 600)] + [(700, 700), (None, 3), (4, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 600)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty(spark):
    assert simhash.groups(docs(spark, [])).count() == 0 and simhash.keep_one(docs(spark, [])).count() == 0
