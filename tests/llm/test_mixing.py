import random
import re

from pyspark.sql import functions as F

from cases import AWKWARD, docs
from smogline.llm import mixing


def poured(sizes, weights, most=3):
    """Targets by sharing out again and again until no source is above its limit."""
    targets, left, free = {s: 0.0 for s in sizes}, float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and free:
        total = sum(weights[s] for s in free)
        share = {s: left * weights[s] / total for s in free}
        left = 0.0
        for s in share:
            targets[s] += share[s]
            if targets[s] >= most * sizes[s]:
                left += targets[s] - most * sizes[s]
                targets[s] = float(most * sizes[s])
                free.discard(s)
    return targets


def test_targets_as_poured(spark):
    rng = random.Random(1)
    for _ in range(5):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000, 100_000]) for i in range(rng.randint(1, 9))}
        names = sorted(sizes)
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        frame = spark.createDataFrame([(i, s, "s" + s, v) for i, (s, v) in enumerate(sizes.items())], "id long, source string, key string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        want = poured(sizes, weights)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_copies_near_targets_at_any_block_size(spark):
    rng = random.Random(2)
    rows = [(i, "ab"[i % 3 == 0], 7 if i % 2 else rng.randint(0, 400)) for i in range(3000)]
    frame = spark.createDataFrame([(i, s, "s" + s, n) for i, s, n in rows], "id long, source string, key string, size long").cache()
    one = {r["id"]: r for r in mixing.copies(frame).collect()}
    two = {r["id"]: r for r in mixing.copies(frame, block_rows=50).collect()}
    assert {k: r["copies"] for k, r in one.items()} == {k: r["copies"] for k, r in two.items()}
    for s in "ab":
        own = [r for r in one.values() if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) < 0.01 * own[0]["target"] + 800
        rate = own[0]["target"] / own[0]["source_size"]
        assert {r["copies"] for r in own} <= {int(rate), int(rate) + 1} and max(r["copies"] for r in own) <= 3


def test_mix_of_awkward_rows(spark):
    frame = docs(spark, AWKWARD + AWKWARD, [*range(len(AWKWARD))] * 2).unionByName(docs(spark, ["null source here", "no id"], [None, None], source=None))
    frame = frame.unionByName(frame.limit(0))
    sizes = mixing.copies(mixing.sizes_of(frame))
    planned = {(r["id"], r["size"], r["source"]): 0 for r in sizes.collect()}
    for r in sizes.collect():
        planned[(r["id"], r["size"], r["source"])] += r["copies"]
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    got = {}
    for r in mixed.select("doc_id", mixing.word_count(F.col("text")), "source").collect():
        got[tuple(r)] = got.get(tuple(r), 0) + 1
    assert got == {k: n for k, n in planned.items() if n}
    assert sorted(map(str, mixing.mix(frame).collect())) == sorted(map(str, mixed.collect()))


def test_empty(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert {r["copies"] for r in mixing.copies(mixing.sizes_of(docs(spark, ["", None, " "]))).collect()} == {0}


def test_texts_are_dealt_once(spark):
    """Joined to their copies, the rows already lie as the window over repeated rows needs them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.mix(docs(spark, AWKWARD * 2, [None, *range(1, len(AWKWARD))] * 2))._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(dealt) > 1 and sum("text#" in columns for columns in dealt) == 1
