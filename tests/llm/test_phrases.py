import random
import re
from collections import Counter

import pytest
from cases import AWKWARD, docs

from smogline.llm import phrases


def brute(texts, top, least, drop=80):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    out = []
    for lang in {g for g, _ in texts}:
        f = Counter()
        for g, text in texts:
            if g != lang:
                continue
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                w = re.findall(r"[^\x20\x09]+", piece)
                f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        n = sum(v for k, v in f.items() if len(k) == 1)
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q[i:i + k] for q, a in known.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
                if 100 * a >= drop * f[q[i:i + k]]}
        found = []
        for p, a in known.items():
            if p not in gone:
                s, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def mined(frame, **limits):
    return sorted(tuple(r) for r in phrases.mine(frame, **limits).collect())


def prose(seed, count, words):
    draw = random.Random(seed)
    names = [f"w{i}" if i % 7 else f"Ω{i}" for i in range(words)]
    idioms = [[draw.choice(names) for _ in range(draw.randint(2, 6))] for _ in range(12)]
    texts = []
    for _ in range(count):
        line = []
        for _ in range(draw.randint(0, 30)):
            line += draw.choice(idioms) if draw.random() < 0.5 else [draw.choice(names)]
            if draw.random() < 0.2:
                line.append(draw.choice([", ", ".", "\t", "\n", " ! "]))
        texts.append(" ".join(w.upper() if draw.random() < 0.1 else w for w in line))
    return texts


@pytest.mark.parametrize("top, width, run_bytes", [(5, 1, 200), (10, 4, 1000), (2000, 16000, phrases.RUN_BYTES)])
def test_as_counting_everything(spark, top, width, run_bytes):
    texts = [(lang, t) for lang, seed, words in (("en", 1, 40), ("de", 2, 15), ("und", 3, 60)) for t in prose(seed, 120, words)]
    frame = spark.createDataFrame([(t, None if g == "und" else g) for g, t in texts], "text string, lang string").repartition(5)
    assert mined(frame, top=top, width=width, run_bytes=run_bytes, least=4) == brute(texts, top, 4)


def test_ties_are_settled_by_count_then_bytes(spark):
    texts = [f"{a} {b}." for a, b in ("ab", "cd", "éf", "zz", "Zy") for _ in range(3)]
    assert mined(docs(spark, texts), top=3, least=3, width=1) == brute([("en", t) for t in texts], 3, 3)


def test_awkward_texts_and_null_languages(spark):
    texts = [*AWKWARD, *["one two three four five"] * 4, None]
    got = mined(docs(spark, texts, lang=None), least=3)
    assert got == brute([("und", t) for t in texts], 2000, 3)
    assert "one two three four" in [r[2] for r in got]


def test_one_hot_phrase_and_nothing_frequent(spark):
    hot = ["buy now " * 500] * 3
    assert mined(docs(spark, hot)) == brute([("en", t) for t in hot], 2000, 30)
    assert mined(docs(spark, ["all words differ here"])) == []
    assert mined(docs(spark, [])) == []


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(9 * 10**18, 9 * 10**18, 3)], "a long, l long, r long")
    assert row.select(phrases.score("a", "l", "r")).first()[0] == 2000000 * 9 * 10**18 // (9 * 10**18 + 3)
