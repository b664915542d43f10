import numpy as np

from cases import AWKWARD, docs
from smogline.llm import langid

RNG = np.random.default_rng(9)
LETTERS = np.array(list("abcdefghijklmnopqrstuvwxyz"))


def texts(n, shape):
    """Texts on three subjects, each with words of its own."""
    subjects = [["".join(RNG.choice(LETTERS, RNG.integers(2, 9), p=chance)) for _ in range(100)] for chance in RNG.dirichlet(np.full(26, shape), 3)]
    return [" ".join(RNG.choice(subjects[i % 3], RNG.integers(4, 40))) for i in range(n)]


def test_grams_of_many_texts_are_the_counts_of_each(monkeypatch):
    some = [*AWKWARD, *texts(50, 1.0), "ΑΣ Σ", "İx", "12 .", "(a) b."]
    for chunk in (langid.CHUNK_CHARS, 100):
        monkeypatch.setattr(langid, "CHUNK_CHARS", chunk)
        sizes, found, times = langid.grams(some)
        ends = np.cumsum(sizes)
        for t, start, end in zip(some, ends - sizes, ends):
            whole = langid.counts(t)
            assert (np.bincount(found[start:end], times[start:end], 1 << langid.BITS) == (0 if whole is None else whole)).all()


def test_the_model_comes_from_every_text(spark):
    """More texts a language than a sample would hold; centroids and limits are those of all of them."""
    own = {"aa": texts(2600, 0.5), "bb": texts(1900, 0.5)}
    frame = docs(spark, own["aa"], lang="aa").union(docs(spark, own["bb"], range(5000, 6900), lang="bb"))
    model = langid.fit(frame)
    learnt = frame.filter(~langid.held_out(langid.F.col("doc_id"))).select("lang", "text").collect()
    assert len(learnt) > 3000 and model.languages == ["aa"] * 3 + ["bb"] * 3
    n, seen = len(learnt), sum(langid.counts(r["text"]) > 0 for r in learnt)
    assert np.allclose(model.idf, np.log((1 + n) / (1 + seen)) + 1)
    for lang in own:
        at = [i for i, x in enumerate(model.languages) if x == lang]
        mine = [r["text"] for r in learnt if r["lang"] == lang]
        vectors = np.stack([langid._weighted(langid.counts(t), model.idf) for t in mine])
        nearest = (vectors @ model.centroids[at].T).argmax(axis=1)
        for k, centre in enumerate(model.centroids[at]):
            total = vectors[nearest == k].sum(axis=0)
            assert np.abs(total / np.linalg.norm(total) - centre).max() < 2e-4
        # every text has a say in the limits
        scores = {}
        for t in mine:
            for part in langid.excerpts(t):
                found = langid.counts(part)
                scores.setdefault(langid.size_bin(found), []).append((model.centroids[at] @ langid._weighted(found, model.idf)).max())
        for size, those in scores.items():
            if len(those) >= langid.EXAMPLES:
                limit = max(langid.FLOOR, langid.SPARE * np.percentile(those, 100 * langid.LOWEST))
                assert abs(model.accepts[at, size] - limit).max() < 1e-3, (lang, size)
