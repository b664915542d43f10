import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import AWKWARD, docs
from smogline.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found)


@given(st.text(alphabet="ab.@-+%0123456789() é", max_size=60))
@settings(deadline=None, max_examples=2000)
def test_base_spans_as_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "79927398713", "1.2.3.4", "256.1.1.1", "10.0.0.255.7", "a@b.c", "@b.c@d.e-f.g", "+1 (743) 555-3824",
                                 "+", " ", ".", "é", "0004111111111111111", "x", "--"]), max_size=8))
@settings(deadline=None, max_examples=1000)
def test_base_spans_of_pieces(parts):
    assert pii.base_spans("".join(parts)) == plain("".join(parts))


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "1 " * 150_000, "a@" * 100_000):
        pii.base_spans(text)
        list(pii.candidates(text, []))


def test_estimation_finds_the_reliable_labelers():
    rng = np.random.default_rng(9)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.85, 0.8, 0.55])
    says = np.where(rng.random((4000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    says[rng.random((4000, 4)) < 0.2] = 0
    patterns, counts = np.unique(says, axis=0, return_counts=True)
    chances, share, true = pii.estimate(patterns, counts.astype(float))
    assert abs(share - 0.4) < 0.05
    for i, r in enumerate(right):
        assert abs(chances[i, 1, 2] / (chances[i, 1, 0] + chances[i, 1, 2]) - r) < 0.06
    at = {tuple(p): t for p, t in zip(patterns.tolist(), true)}
    assert np.mean([(at[tuple(s)] > 0.5) == t for s, t in zip(says.tolist(), truth)]) > 0.93


def test_further_spans_are_added_and_base_ones_stay(spark):
    rng = random.Random(10)
    texts = [f"Call {rng.choice(['phone', 'tel'])} ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} or +1 (743) 555-38{rng.randint(10, 99)}"
             for _ in range(60)]
    texts += [f"order part {rng.randint(200, 999)}-000-0000 version" for _ in range(60)] + ["nothing here"] * 20
    texts += [f"mail jo{i} [at] example [dot] com or jo{i}@example.com" for i in range(30)] + ["we met at noon. dot com was there"]
    frame = docs(spark, texts + AWKWARD)
    found = {r["doc_id"]: r for r in pii.find(frame, pii.fit(frame)).collect()}
    for i, t in enumerate(texts + AWKWARD):
        base = plain(t or "")
        assert found[i]["base"] == pii.joined(base) and set(found[i]["base"].split(",")) - {""} <= set(found[i]["spans"].split(","))
        assert [found[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
    assert all(found[i]["spans"].count("phone") == 2 for i in range(60))
    assert all(found[i]["spans"] == "" for i in range(60, 140))
    assert all(found[i]["spans"].count("email") == 2 for i in range(140, 170)) and found[170]["spans"] == ""


def test_empty(spark):
    frame = docs(spark, [])
    assert pii.find(frame, pii.fit(frame)).count() == 0
