"""A quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted feature by feature in turn; their sum is a table of values per
bin of each feature, and of pairs of features. A text's score is the sum of its bins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.batches import column, map_batches
from smogline.llm.langid import held_out

FEATURES = ("log_chars", "log_words", "word_chars", "letters", "upper", "digits", "space", "marks", "symbols", "other_marks",
            "wide", "lines", "line_chars", "closed_lines", "different_words", "same_as_before", "upper_words", "marked_words",
            "bare_words", "ends_closed")
SAMPLE = 20_000
BINS = 32
ROUNDS = 200
RATE = 0.1
PAIRS = 6
THRESHOLD = 0.7
#: Fixed classes of ASCII characters: sentence marks, and symbols that prose hardly has.
MARKS, SYMBOLS = b".,;:?'\"()-", b"!#$%&*|@<>{}[]\\^~_=+/`"


def _classes() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    for i in range(256):
        c = bytes([i])
        kinds[i] = (1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c in b" \t\n\r\x0b\x0c" else
                    5 if c in MARKS else 6 if c in SYMBOLS else 7 if i < 128 else 8)
    return kinds


_KINDS = _classes()


def features(text: str | None) -> list[float]:
    """Measures of a whole text, none of which depends on its language's words; null counts as empty."""
    raw = (text or "").encode("utf-8")
    n = max(1, len(raw))
    kinds = np.bincount(_KINDS[np.frombuffer(raw, dtype=np.uint8)], minlength=9)[:9]
    words, lines = raw.split(), raw.split(b"\n")
    w = max(1, len(words))
    full = [line.rstrip() for line in lines if line.strip()]
    same = sum(map(bytes.__eq__, words[1:], words))
    upper = sum(map(bytes.isupper, words))
    alpha = sum(map(bytes.isalpha, words))
    marked = sum(1 for x in words if x[-1] in SYMBOLS)
    closed = sum(1 for line in full if line[-1] in b".?!:")
    return [float(np.log1p(len(raw))), float(np.log1p(len(words))), len(raw) / w, (kinds[1] + kinds[2]) / n,
            kinds[2] / max(1, kinds[1] + kinds[2]), kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n, kinds[7] / n, kinds[8] / n,
            float(np.log1p(len(full))), float(np.log1p(len(raw) / max(1, len(full)))), closed / max(1, len(full)),
            len(set(words)) / w, same / w, upper / w, marked / w, alpha / w, float(bool(full) and full[-1][-1] in b".?!")]


@dataclass
class Model:
    """Bin edges per feature, a table per feature, tables for pairs of features, and the constant."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        total = np.full(len(x), self.base)
        for i, table in enumerate(self.tables):
            total += table[at[:, i]]
        for i, j, table in self.pairs:
            total += table[at[:, i], at[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _leaf(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.clip(gradient / (weight + 1.0), -4, 4)


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values per bin of a tree with few leaves: the best cut, then the best cut of either side."""
    out, parts = np.zeros(len(gradient)), [(0, len(gradient))]
    gain = lambda g, w: g * g / (w + 1.0)
    while len(parts) < leaves:
        best = (1e-6, None, None)
        for part, (a, b) in enumerate(parts):
            g, w = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
            if b - a > 1:
                gains = gain(g[:-1], w[:-1]) + gain(g[-1] - g[:-1], w[-1] - w[:-1]) - gain(g[-1], w[-1])
                at = int(gains.argmax())
                best = max(best, (float(gains[at]), part, a + at + 1), key=lambda t: t[0])
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    for a, b in parts:
        out[a:b] = _leaf(gradient[a:b].sum(), weight[a:b].sum())
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features once: its gain and its values per pair of bins."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    a, c = g[:-1, :-1], w[:-1, :-1]
    quarters = [(a, c), (g[:-1, -1:] - a, w[:-1, -1:] - c), (g[-1:, :-1] - a, w[-1:, :-1] - c),
                (g[-1, -1] - g[:-1, -1:] - g[-1:, :-1] + a, w[-1, -1] - w[:-1, -1:] - w[-1:, :-1] + c)]
    if not a.size:
        return 0.0, np.zeros_like(gradient)
    gains = sum(x * x / (y + 1.0) for x, y in quarters)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.zeros_like(gradient)
    for (x, y), rows, cols in zip(quarters, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)),
                                  (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None))):
        out[rows, cols] = _leaf(x[i, j], y[i, j])
    return float(gains[i, j] - g[-1, -1] ** 2 / (w[-1, -1] + 1.0)), out


def train(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS, bins: int = BINS) -> Model:
    """Boost one tree per feature in turn, round by round; then trees on the pairs that explain most of what is left."""
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], [], float(np.log(share / (1 - share))))
    at, logit = model.bins(x), np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            g, w = slope()
            step = rate * _tree(np.bincount(at[:, i], g, len(table)), np.bincount(at[:, i], w, len(table)))
            table += step
            logit += step[at[:, i]]

    def grid(i: int, j: int) -> tuple[float, np.ndarray]:
        g, w = slope()
        shape = (len(model.tables[i]), len(model.tables[j]))
        flat = at[:, i] * shape[1] + at[:, j]
        return _quadrants(*[np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, w)])

    ranked = sorted(((grid(i, j)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)[:pairs]
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for gain, i, j in ranked if gain > 0]
    for _ in range(rounds // 4):
        for i, j, table in model.pairs:
            step = rate * grid(i, j)[1]
            table += step
            logit += step[at[:, i], at[:, j]]
    return model


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *extra: str) -> DataFrame:
    """doc_id, further columns of plain types, and the features of every row."""
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        own = {c: batch.column(c) for c in ("doc_id", *extra)}
        return {**own, "features": [features(t) for t in column(batch, "text")]}

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *extra)
    schema = ", ".join([f"doc_id {kinds[doc_id]}", *[f"{c} {kinds[c]}" for c in extra], "features array<double>"])
    return map_batches(rows, run, schema)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
        sample: int = SAMPLE, modulus: int = 4, remainder: int = 2) -> Model:
    """Learn from about ``sample`` labelled rows that are not held out, drawn by a hash of the id.

    Only the features of that bounded sample reach the driver. A label other than 0 and 1, and a
    document without a label, is no example; a document labelled several times counts as its smallest label.
    Without examples of both kinds the model gives every text the same score.
    """
    known = (labels.select(F.col(doc_id).alias("_label_id"), F.col(quality).cast("int").alias("_label"))
             .filter(F.col("_label").isin(0, 1) & ~held_out(F.col("_label_id"), modulus, remainder))
             .groupBy("_label_id").agg(F.min("_label").alias("_label")))
    n = known.count()
    draw = F.xxhash64("_label_id", F.lit(13)).bitwiseAND(F.lit((1 << 32) - 1)) / F.lit(float(1 << 32))
    known = known.filter(draw < float(sample) / max(1, n))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # the sample is bounded by its parameter, so it may go to every task: texts are not dealt
    joined = own.join(F.broadcast(known), own["doc_id"] == known["_label_id"]).select("doc_id", "text", "_label")
    rows = sorted((r["doc_id"], r["_label"], list(r["features"])) for r in measured(joined, "doc_id", "text", "_label").collect())
    if len({r[1] for r in rows}) < 2:
        share = np.mean([r[1] for r in rows]) if rows else 0.5
        return Model([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [], float(np.log((share + 0.01) / (1.01 - share))))
    return train(np.array([r[2] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
          modulus: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, score (0 to 1, the chance of label 1) and predicted for every row of ``docs``.

    A null text is scored like the empty one. Only the text decides, so repeated rows and
    copies score alike; other columns are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few tables of fixed size

    def run(batch: pa.RecordBatch) -> dict:
        x = np.array([features(t) for t in column(batch, "text")]).reshape(-1, len(FEATURES))
        scores = shared.value.score(x)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores,
                "predicted": (scores >= threshold).astype(np.int32)}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       held_out(F.col(doc_id), modulus, remainder).alias("held_out"))
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")
