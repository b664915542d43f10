from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from cases import AWKWARD, docs
from smogline.llm import mixing, pieces
from smogline.session import cut

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage made of what the one before had kept."""
    made, frame = [spark.read.parquet(f"{FOLDER}/documents.parquet")], spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in C.STAGES:
        frame = cut(stage(spark, frame, FOLDER))
        made.append(frame)
    return made


def test_columns(stages):
    assert all(f.columns == COLUMNS for f in stages[:-1])


def test_every_stage_on_its_input(stages):
    from test_lines import brute as line_brute
    from test_simhash import groups, plain

    start, spoken, lined, single, mixed, tokens = [f.collect() for f in stages]
    assert {r["doc_id"] for r in start} - {r["doc_id"] for r in spoken} == {
        r["doc_id"] for r in start if not r["text"] or not any(c.isalpha() for c in r["text"])}
    want = line_brute([(r["doc_id"], r["text"]) for r in spoken])
    assert sorted(((r["doc_id"], r["text"]) for r in lined), key=str) == [w[:2] for w in want]
    assert all(r["n_chars"] == len(r["text"]) for r in lined)
    ids = [r["doc_id"] for r in lined]
    least = groups(ids, [plain(r["text"]) for r in lined])
    assert sorted(r["doc_id"] for r in single) == sorted(set(least))
    planned = {r["id"]: r["copies"] for r in mixing.copies(mixing.sizes_of(stages[3])).collect()}
    assert Counter(r["doc_id"] for r in mixed) == Counter({i: n for i, n in planned.items() if n})
    known = pieces.load()
    texts = {r["doc_id"]: r["text"] for r in mixed}
    assert len(tokens) == len(mixed)
    for r in tokens:
        assert b"".join(known.raw[i] for i in r["ids"]).decode()[1:] == texts[r["doc_id"]] and r["n_pieces"] == len(r["ids"])


def test_run_gives_the_last_stage(spark, stages):
    whole = C.run(spark, FOLDER)
    key = lambda f: sorted(map(str, f.select("doc_id", "source", "lang", "n_pieces", F.hash("ids")).collect()))
    assert key(whole) == key(stages[-1])


def test_awkward_and_empty(spark):
    good = ["The and of this that with have from they been said which " + w for w in ("one", "two", "three")]
    for frame in (docs(spark, AWKWARD + good + good, [None, *range(len(AWKWARD) + 5)]), docs(spark, [])):
        extra = frame
        for name, stage in C.STAGES:
            extra = cut(stage(spark, extra, FOLDER))
            if name != "sentencepiece":
                assert extra.columns == frame.columns
        extra.count()
