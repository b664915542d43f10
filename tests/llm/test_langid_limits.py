import base64
import random
import string

import pytest

from cases import docs
from smogline.llm import langid

FOLDER = "/root/testdata/sf0.01"
RNG = random.Random(2)
FAR = [
    "La città era tranquilla quella mattina e nessuno sapeva ancora che cosa sarebbe successo nel pomeriggio quando arrivarono gli ospiti "
    "dalla montagna con molte notizie sulla raccolta delle olive e del vino nuovo",
    "Wczoraj wieczorem poszedłem do sklepu żeby kupić chleb i mleko ale wszystkie sklepy były już zamknięte więc wróciłem do domu",
    "Eilen illalla menin kauppaan ostamaan leipää ja maitoa mutta kaikki kaupat olivat jo kiinni joten palasin kotiin ja söin illallista",
    "Jana jioni nilikwenda dukani kununua mkate na maziwa lakini maduka yote yalikuwa yamefungwa kwa hiyo nilirudi nyumbani nikala chakula",
    " ".join("".join(RNG.choice(string.ascii_lowercase) for _ in range(RNG.randint(2, 9))) for _ in range(60)),
    base64.b64encode(RNG.randbytes(400)).decode(),
    '<div class="row"><span id="x">' * 10,
    "Москва слезам не верит и никогда не верила этим людям",
]


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_other_languages_and_gibberish_are_rejected(spark, model):
    odd = docs(spark, FAR)
    assert all(r["rejected"] for r in langid.identify(odd, model).collect())
    assert langid.accept(odd, model).count() == 0


def test_clean_texts_of_every_length_stay(spark, model):
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").filter(langid.held_out(langid.F.col("doc_id"))).collect()]
    words = [t.split() for t in texts if t and len(t.split()) >= 64]
    for n in (2, 4, 8, 16, 64):
        short = docs(spark, [" ".join(w[-n:]) for w in words])
        kept = langid.accept(short, model).count()
        assert kept >= 0.98 * len(words), (n, kept, len(words))
    assert (model.accepts[:, 18] > 0.4).all() and (model.accepts[:, 6] < 0.2).all()


def test_excerpts_and_sizes():
    assert [len(e.split()) for e in langid.excerpts(" ".join("abcdefghi"))] == [1, 2, 4, 8, 9]
    assert [len(e) for e in langid.excerpts("漢" * 100)] == [1, 2, 4, 8, 16, 32, 64, 100]
    assert list(langid.excerpts("one")) == ["one"]
    assert langid.size_bin(langid.counts("to to to to")) == langid.size_bin(langid.counts("to to"))
