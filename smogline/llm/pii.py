"""Personal data in texts: fixed patterns, and further spans found by weak supervision.

Labelers (formats, gazetteers, context words) vote on candidate spans.
Expectation-maximisation over the counts of vote patterns estimates how reliable each of
them is; the resulting probabilities train the classifier that decides about spans.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.batches import column, map_batches, map_stream

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 40
THRESHOLD = 0.5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where a run of digits does, and no part of it can be given back
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the fixed patterns' matches, in order.

    Per kind the leftmost matches that do not overlap; those that fail their check are dropped.
    """
    if not text:
        return []
    found, free = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, 0, m.end()))
            free = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# Candidates that the fixed patterns miss, by kind number: addresses spelled out, six-group
# addresses, grouped card numbers with other separators, national telephone numbers.
_LOOSE = (
    (0, re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63} ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,10}(?![\w-])")),
    (1, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])")),
    (3, re.compile(r"(?<![0-9+.-])0[0-9]{1,4}[ /-][0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9]|[.-][0-9])")),
)
# what each loose pattern cannot match without
_HINT = (re.compile(r" at |\(at\)|\[at\]"), re.compile(r":[0-9A-Fa-f]{1,4}:"), re.compile(r"[0-9]{4}[./_][0-9]{4}"),
         re.compile(r"[0-9]{3}[ .-][0-9]{4}"), re.compile(r"(?<![0-9])0[0-9]{1,4}[ /-][0-9]{3}"))

#: Fixed words before a span that speak for its kind, and words that speak against any.
_FOR = tuple(re.compile(p, re.I) for p in (
    r"\b(?:e-?mail|mail|contact|write to|reach)\b", r"\b(?:ip|address|host|server|client|login)\b",
    r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b",
    r"\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|telefono|teléfono|téléphone)\b"))
_AGAINST = re.compile(r"\b(?:isbn|issn|order|invoice|version|serial|part|item|page|ref|doi|sku|build|code|look|meet|arrived?)\b", re.I)
_ENDINGS = frozenset(("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "example", "test"))


def _gazetteer(kind: int, span: str) -> int:
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z]+", span)[-1].lower() in _ENDINGS else -1
    if kind == 1:
        return 1 if ":" in span or not span.startswith(("0.", "255.")) else -1
    digits = _digits(span)
    if kind == 2:
        return 1 if digits[0] in "3456" else -1
    return 1 if digits[0] in "23456789" or span.startswith(("+", "0")) else -1


def _form(kind: int, span: str) -> int:
    if kind == 0:
        return 1 if "@" in span or "[" in span or "(" in span else -1
    if kind == 1:
        return 1
    if kind == 2:
        return 1 if luhn(_digits(span)) else -1
    marks = {c for c in span if c in ".-/"}
    return 1 if "(" in span or "+" in span else 0 if len(marks) == 1 else -1


def _variety(kind: int, span: str) -> int:
    """Numbers of one or two different digits are hardly anyone's."""
    if kind == 0:
        return 0
    return -1 if len(set(_digits(span))) <= 2 else 0


def votes(text: str, start: int, end: int, kind: int, based: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """What the labelers say (1 for, -1 against, 0 nothing) and the classifier's features of a span."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    named, against = bool(_FOR[kind].search(before)), bool(_AGAINST.search(before))
    says = (1 if based else 0, _form(kind, span), _gazetteer(kind, span), 1 if named else 0, -1 if against else 0, _variety(kind, span))
    other = any(p.search(before) for i, p in enumerate(_FOR) if i != kind)
    shape = (int(based), int(_form(kind, span) > 0), int(_form(kind, span) < 0), int(_gazetteer(kind, span) > 0), int(named), int(against),
             int(_variety(kind, span) < 0), int(other), int(bool(after[:1].strip()) and after[0].isalnum()), int(" " in span))
    return says, shape


def candidates(text: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, int]]:
    """(start, kind number, end) of loose matches that touch no base span and no earlier candidate."""
    taken = [(s, e) for s, _, e in base]
    for (kind, pattern), hint in zip(_LOOSE, _HINT):
        if hint.search(text):
            for m in pattern.finditer(text):
                if all(m.end() <= s or e <= m.start() for s, e in taken):
                    taken.append((m.start(), m.end()))
                    yield m.start(), kind, m.end()


@dataclass
class Model:
    """Per kind: each labeler's chances of its votes by truth, the share of true spans, the classifier's weights."""

    chances: dict[int, np.ndarray] = field(default_factory=dict)
    shares: dict[int, float] = field(default_factory=dict)
    weights: dict[int, np.ndarray] = field(default_factory=dict)

    def probability(self, kind: int, shape: tuple[int, ...]) -> float:
        w = self.weights.get(kind)
        if w is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(w[0] + np.dot(w[1:], shape), -30, 30))))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over vote patterns: chances[labeler, truth, vote + 1], the share of true spans, each pattern's probability.

    Labelers start out as mostly right, and ten made-up votes apiece keep them so where there
    is little to count.
    """
    prior = np.array([[0.5, 0.35, 0.15], [0.1, 0.35, 0.55]])
    chances, share = np.repeat(prior[None], patterns.shape[1], axis=0), 0.5
    at = patterns + 1
    for _ in range(rounds):
        logs = np.stack([np.log(s) + sum(np.log(chances[i, y, at[:, i]]) for i in range(at.shape[1]))
                         for y, s in ((0, 1 - share), (1, share))])
        top = logs.max(axis=0)
        true = np.exp(logs[1] - top) / np.exp(logs - top).sum(axis=0)
        fresh = np.empty_like(chances)
        for i in range(at.shape[1]):
            for y, mass in ((0, counts * (1 - true)), (1, counts * true)):
                sums = np.bincount(at[:, i], mass, 3) + 10 * prior[y]
                fresh[i, y] = sums / sums.sum()
        new = float((counts @ true + 1) / (counts.sum() + 2))
        done = np.abs(fresh - chances).max() < 1e-6
        chances, share = fresh, new
        if done:
            break
    return chances, share, true


def logistic(x: np.ndarray, soft: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on probabilities, by Newton's method; the first is the constant."""
    full = np.c_[np.ones(len(x)), x]
    w = np.zeros(full.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 0.01
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve((full * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ full + penalty,
                               full.T @ (counts * (soft - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Learn from the candidate and base spans of all texts, without any labels.

    Tasks count equal pairs of votes and features; there are only so many of them, whatever the
    number of texts, and only these counts reach the driver. Texts without spans, null ones and an
    empty table teach nothing; a kind never seen gets no further spans.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen = Counter()
        for batch in batches:
            for t in column(batch, "text"):
                base = base_spans(t)
                for s, k, e in base:
                    seen[(k, *votes(t, s, e, k, True))] += 1
                if t:
                    for s, k, e in candidates(t, base):
                        seen[(k, *votes(t, s, e, k, False))] += 1
        yield {"kind": [k for k, _, _ in seen], "says": [list(v) for _, v, _ in seen], "shape": [list(f) for _, _, f in seen],
               "n": list(seen.values())}

    counted = (map_stream(docs.select(F.col(text).alias("text")), tally, "kind int, says array<int>, shape array<int>, n long")
               .groupBy("kind", "says", "shape").agg(F.sum("n").alias("n")).orderBy("kind", "says", "shape").collect())
    model = Model()
    for kind in sorted({r["kind"] for r in counted}):
        own = [r for r in counted if r["kind"] == kind]
        n = np.array([r["n"] for r in own], dtype=np.float64)
        chances, share, true = estimate(np.array([r["says"] for r in own]), n)
        model.chances[kind], model.shares[kind] = chances, share
        model.weights[kind] = logistic(np.array([r["shape"] for r in own], dtype=np.float64), true, n)
    return model


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base (both of the fixed patterns) and spans (all) per row.

    Spans are kind:start:end in code points, by start and kind, comma-joined. Base spans
    always stay; a candidate is added when the classifier gives it at least ``threshold``. Null and
    empty texts have none, equal texts have equal spans; an empty table gives no rows, other
    columns are ignored. Whole texts are searched, in time that grows with their length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batch: pa.RecordBatch) -> dict:
        base, spans, numbers = [], [], [[], [], [], []]
        for t in column(batch, "text"):
            own = base_spans(t)
            more = [(s, k, e) for s, k, e in candidates(t, own)
                    if shared.value.probability(k, votes(t, s, e, k, False)[1]) >= threshold] if t else []
            base.append(joined(own))
            spans.append(joined(sorted(own + more)))
            for k in range(4):
                numbers[k].append(sum(1 for span in own if span[1] == k))
        return {"doc_id": batch.column("doc_id"), **{f"n_{k}": n for k, n in zip(KINDS, numbers)}, "base": base, "spans": spans}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
