import hashlib

import pytest
from cases import AWKWARD, docs

from smogline.llm import bpe
from smogline.llm.queries import QUERIES, table

FOLDER = "/root/testdata/sf0.001"
MARKS = [chr(c) for c in (*range(0x300, 0x370), 0x483, 0x591, 0x3099, 0x20D0, 0xFE20)]
HARD = ["don't we'll it's I'M THEY'RE o'clock 's", "a<|endoftext|>b", "<|startoftext|> x <|ENDOFTEXT|>", "Ab.c,d;e:f!g?h", "a,.b ..c", "3.14 1,000 x2y",
        "İSTANBUL ΣΊΣΥΦΟΣ ΑΣ ẞ ﬁ ǅ K Å", "ä́ Å, é. ̈x", "漢字かな。交じり", "a b c　d\u0085e\x1cf​g",
        "﻿x \0 \x7f", "≠ ≮", "emoji 👩‍👩‍👧 🇩🇪", "x" * 3000, "!?" * 500, " ".join(f"a{i}" for i in range(3000))]


@pytest.fixture(scope="module")
def tokenizer():
    with open(bpe.MODEL, encoding="utf-8") as file:
        return bpe.load(file.read())


@pytest.fixture(scope="module")
def codec(spark):
    return bpe.Codec(spark)


def plain(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("run_bytes", [50, bpe.RUN_BYTES])
def test_as_the_tokenizer_does(spark, codec, tokenizer, run_bytes):
    texts = [*AWKWARD, *HARD, *HARD[:3], None]
    done = bpe.decode(bpe.encode(docs(spark, texts), codec, run_bytes=run_bytes), codec)
    got = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in done.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == plain(tokenizer, text), text


def test_words_one_after_the_other(tokenizer):
    split = bpe.splitter(tokenizer)
    texts = [a + m + end for a in "AEIKNOSTUXYZaeinouyz" for m in MARKS for end in ("", "́", ", B")]
    for text in [*texts, *HARD]:
        words = [w.decode("utf-8") for w in split(text.encode("utf-8"))]
        ids = [i for e in tokenizer.encode_batch(words, add_special_tokens=False) for i in e.ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_repeated_and_null_ids_and_empty_tables(spark, codec):
    same = bpe.encode(docs(spark, ["a b", "a b", "c", None], ids=[1, 1, None, None]), codec).collect()
    assert sorted((r["doc_id"] is None, len(r["ids"])) for r in same) == [(False, 2), (False, 2), (True, 0), (True, 1)]
    assert bpe.decode(bpe.encode(docs(spark, []), codec), codec).collect() == []


def test_decode_of_given_ids(spark, codec):
    rows = spark.createDataFrame([(1, [320, None, 999_999, 49407], "x"), (2, None, "x"), (3, [], "x")], "doc_id long, ids array<int>, code string")
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.decode(rows, codec).collect()}
    assert got == {1: ([320, None, 999_999, 49407], "a</w> <|endoftext|>"), 2: (None, None), 3: ([], "")}


def test_query_against_the_tokenizer(spark, tokenizer):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_bpe"](spark, FOLDER).collect()}
    source = table(spark, FOLDER, "documents").collect()
    assert len(got) == len(source)
    for r in source:
        ids, text = plain(tokenizer, r["text"])
        assert got[r["doc_id"]] == (len(ids), *[hashlib.sha256(s.encode("utf-8")).hexdigest() for s in (" ".join(map(str, ids)), text)])


def test_ids_are_put_back_a_few_texts_at_a_time(spark, tokenizer, codec, monkeypatch):
    """No array of a run's words may be whole but its codes: the pieces join up, empty and long texts among them."""
    assert bpe.SOME_WORDS < bpe.RUN_BYTES >> 5
    monkeypatch.setattr(bpe, "SOME_WORDS", 3)
    texts = ["", "a b", None, "c d e f g h", " ", "i", "j", "k l m", "", *HARD, "", None]
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(docs(spark, texts), codec).collect()}
    assert got == {i: plain(tokenizer, t)[0] for i, t in enumerate(texts)}
