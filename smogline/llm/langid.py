"""Language identification by nearest centroid over hashed character n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from smogline.llm.batches import column, map_batches, map_stream
from smogline.llm.words import pack, unpack
from smogline.session import cut

BITS = 13
GRAMS = 3
CENTROIDS = 3
ROUNDS = 20
STILL = 1e-4
MAX_LANGUAGES = 200
PART_CHARS = 1 << 20
CHUNK_CHARS = 1 << 17
FLOOR = 0.04
SPARE = 0.8
LOWEST = 0.01
EXAMPLES = 5
BINS = 2 * BITS + 1
#: Sums are whole multiples of 1 / UNIT, so that their order does not matter; they travel in slices of SLICE numbers.
UNIT = float(1 << 32)
SLICE = 1 << 11
#: Cosines are counted in steps of 1 / GRID.
GRID = 1 << 11
PACKED = "lang string, texts long, n long, sizes binary, grams binary, times binary"
UNDETERMINED = "und"
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters, once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def counts(text: str | None, bits: int = BITS) -> np.ndarray | None:
    """How often each hashed n-gram of one to three characters occurs in a text; None if it has no letter.

    Text is lower-cased; every run of other characters than letters is one space. Long texts
    are worked off in parts that overlap by two characters.
    """
    if not text:
        return None
    total, any_, before = np.zeros(1 << bits), False, np.full(1, 32, dtype=np.uint64)
    for start in range(0, len(text), PART_CHARS):
        codes = np.frombuffer(text[start:start + PART_CHARS].lower().encode("utf-32-le"), dtype="<u4")
        known = letters()[codes]
        any_ = any_ or bool(known.any())
        codes = np.concatenate([before, np.where(known, codes, 32).astype(np.uint64)])
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
        if len(before) > 1 and len(codes) > 1:  # what the part before has counted is only context
            skip = len(before)
        else:
            skip = 1
        hashed = codes.copy()
        for n in range(GRAMS):
            if n:
                hashed = hashed[:-1] * np.uint64(0x100000001B3) + codes[n:]
            fresh = hashed[max(0, skip - n):]
            at = (fresh * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
            total += np.bincount(at.astype(np.int64), minlength=1 << bits)
        before = codes[-(GRAMS - 1):]
    return total if any_ else None


def grams(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`counts` of many texts without the zeros: how many different n-grams each text has, which, and how often."""
    sizes, found, times, start = np.zeros(len(texts), dtype=np.int64), [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], 0
    while start < len(texts):
        end, chars = start + 1, len(texts[start] or "")
        while end < len(texts) and chars + len(texts[end] or "") + 1 <= CHUNK_CHARS:
            chars, end = chars + len(texts[end] or "") + 1, end + 1
        if chars > CHUNK_CHARS:  # one long text
            whole = counts(texts[start], bits)
            at = np.zeros(0, dtype=np.int64) if whole is None else np.flatnonzero(whole)
            sizes[start] = len(at)
            found.append(at)
            times.append(np.zeros(0, dtype=np.int64) if whole is None else whole[at].astype(np.int64))
        else:
            parts = [" " + (t or "").lower() for t in texts[start:end]]
            lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
            codes = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")
            known = letters()[codes]
            stays = np.r_[True, known[1:] | known[:-1]]
            first = np.cumsum(lengths) - lengths
            stays[first] = True
            context = np.zeros(len(codes), dtype=bool)
            context[first] = True
            codes, owner = np.where(known, codes, 32)[stays].astype(np.uint64), np.repeat(np.arange(len(parts)), lengths)[stays]
            hashed, keys = codes, []
            for n in range(GRAMS):
                if n:
                    hashed = hashed[:-1] * np.uint64(0x100000001B3) + codes[n:]
                own = owner[:len(hashed)]
                at = ((hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64) + (own << bits)
                keys.append(at[own == owner[n:]] if n else at[~context[stays]])
            together = np.concatenate(keys)
            if len(parts) << bits < 1 << 31:
                together = together.astype(np.int32)
            together.sort()
            edges = np.flatnonzero(np.r_[True, together[1:] != together[:-1]]) if len(together) else np.zeros(0, dtype=np.int64)
            times.append(np.diff(np.r_[edges, len(together)]))
            together = together[edges].astype(np.int64)
            sizes[start:end] = np.bincount(together >> bits, minlength=len(parts))
            found.append(together & ((1 << bits) - 1))
        start = end
    return sizes, np.concatenate(found), np.concatenate(times)


def _weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF, the frequency by its logarithm."""
    vector = np.log1p(found) * idf
    norm = np.sqrt((vector * vector).sum())
    return vector / norm if norm > 0 else vector


def _unit_rows(sizes: np.ndarray, found: np.ndarray, times: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_weighted` for the texts of :func:`grams`, none of them without a letter: all weights, and where each text begins."""
    starts = np.cumsum(sizes) - sizes
    weights = np.log1p(times) * idf[found]
    return weights / np.repeat(np.sqrt(np.add.reduceat(weights * weights, starts)), sizes), starts


def _near(weights: np.ndarray, starts: np.ndarray, found: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The cosine of every centre (a row) with every text (a column)."""
    return np.stack([np.add.reduceat(weights * centre[found], starts) for centre in centres])


def _size_bins(sizes: np.ndarray) -> np.ndarray:
    """:func:`size_bin` of texts by how many different n-grams they have."""
    return np.minimum(BINS - 1, (2 * np.log2(np.maximum(1, sizes))).astype(np.int64))


def size_bin(found: np.ndarray) -> int:
    """Texts of about as many different n-grams, two bins for each doubling: repeats do not lengthen a text."""
    return min(BINS - 1, int(2 * np.log2(max(1, np.count_nonzero(found)))))


def excerpts(text: str) -> Iterator[str]:
    """A run of 1, 2, 4, ... words at a place given by a hash, then the text; of characters where words are not parted."""
    units, glue = text.split(), " "
    if len(text) > 20 * len(units):
        units, glue = text, ""
    n, seed = 1, zlib.crc32(text.encode())
    while n < len(units):
        start = zlib.crc32(n.to_bytes(8, "little"), seed) % (len(units) - n + 1)
        yield glue.join(units[start:start + n])
        n *= 2
    yield text


@dataclass
class Model:
    """Languages, centroids (a row each), and the least cosine at which a centroid accepts a text, by :func:`size_bin`."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    accepts: np.ndarray


def held_out(doc_id, modulus: int = 5, remainder: int = 0):
    """Whether a document is not learnt from; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus)) == remainder


def cluster(vectors: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and the nearest one of each unit vector; seeds lie far from each other."""
    seeds = [int((vectors @ vectors.mean(axis=0)).argmax())]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int((vectors @ vectors[seeds].T).max(axis=1).argmin()))
    centres, own = vectors[seeds], np.zeros(len(vectors), dtype=np.int64)
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
        fresh = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1)), 1e-12)[:, None]
        if np.allclose(fresh, centres):
            break
        centres = fresh
    return centres, (vectors @ centres.T).argmax(axis=1)


def _packed(train: DataFrame, bits: int) -> DataFrame:
    """The n-grams of all texts of ``train`` (text, lang) that have a letter, a row per batch and language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for t, own in zip(column(batch, "text"), column(batch, "lang")):
                texts.setdefault(own, []).append(t)
            for own, some in texts.items():
                sizes, found, times = grams(some, bits)
                sizes = sizes[sizes > 0]
                if len(sizes):
                    yield {"lang": [own], "texts": [len(sizes)], "n": [len(found)], "sizes": [pack(sizes)],
                           "grams": [pack(np.diff(found, prepend=0))], "times": [pack(times)]}

    return cut(map_stream(train.select("text", "lang"), run, PACKED))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Language, sizes, n-grams and how often of every row."""
    for batch in batches:
        for row in batch.to_pylist():
            found = np.cumsum(unpack(row["grams"], row["n"]), dtype=np.int64)
            yield row["lang"], unpack(row["sizes"], row["texts"]).astype(np.int64), found, unpack(row["times"], row["n"])


def _sums(packed: DataFrame, idf: np.ndarray, groups: int, centres: dict[str, np.ndarray] | None = None) -> dict:
    """By language, the sums of the unit vectors of each group's texts, a row each, and how many texts those are.

    A text belongs to the nearest of its language's ``centres``, without them to the first group.
    What goes to the driver is bounded by languages, groups and n-grams.
    """
    shared = packed.sparkSession.sparkContext.broadcast((idf, centres))
    width = len(idf) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        idf, centres = shared.value
        totals: dict[str, np.ndarray] = {}
        for lang, sizes, found, times in _unpacked(batches):
            weights, starts = _unit_rows(sizes, found, times, idf)
            own = np.zeros(len(sizes), dtype=np.int64) if centres is None else _near(weights, starts, found, centres[lang]).argmax(axis=0)
            if lang not in totals:
                totals[lang] = np.zeros(groups * width, dtype=np.int64)
            added = np.bincount(np.repeat(own * width, sizes) + found, weights=weights, minlength=groups * width)
            totals[lang] += np.rint(added * UNIT).astype(np.int64)
            totals[lang][width - 1::width] += np.bincount(own, minlength=groups)
        for lang, total in totals.items():
            for start in range(0, len(total), SLICE):
                if (part := total[start:start + SLICE]).any():
                    yield {"lang": [lang], "start": [start], "sums": [part.tobytes()]}

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, dtype=np.int64) for v in rows.column("sums").to_pylist())
        return pa.table({"lang": rows.column("lang")[:1], "start": rows.column("start")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema, found = "lang string, start int, sums binary", {}
    for r in map_stream(packed, run, schema).groupBy("lang", "start").applyInArrow(add, schema).collect():
        part = np.frombuffer(r["sums"], dtype=np.int64)
        found.setdefault(r["lang"], np.zeros(groups * width, dtype=np.int64))[r["start"]:r["start"] + len(part)] = part
    shared.destroy()
    return {lang: (total.reshape(groups, width)[:, :-1] / UNIT, total.reshape(groups, width)[:, -1]) for lang, total in found.items()}


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1)), 1e-12)[:, None]


def _extremes(packed: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray], far: bool) -> dict[str, np.ndarray]:
    """By language, the unit vector of the text nearest to one of its ``centres``, or of the one farthest from all of them."""
    shared = packed.sparkSession.sparkContext.broadcast((idf, centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        idf, centres = shared.value
        best: dict[str, tuple] = {}
        for lang, sizes, found, times in _unpacked(batches):
            weights, starts = _unit_rows(sizes, found, times, idf)
            near = _near(weights, starts, found, centres[lang]).max(axis=0) * (-1 if far else 1)
            at = int(near.argmax())
            if lang not in best or near[at] > best[lang][0]:
                own = slice(starts[at], starts[at] + sizes[at])
                best[lang] = float(near[at]), found[own].tobytes(), weights[own].tobytes()
        for lang, (score, found, weights) in best.items():
            yield {"lang": [lang], "score": [score], "found": [found], "weights": [weights]}

    rows = map_stream(packed, run, "lang string, score double, found binary, weights binary")
    rows = rows.groupBy("lang").agg(F.max(F.struct("score", "found", "weights")).alias("best")).collect()  # a text a language
    shared.destroy()
    vectors = {}
    for r in rows:
        vectors[r["lang"]] = np.zeros(len(idf))
        vectors[r["lang"]][np.frombuffer(r["best"]["found"], dtype=np.int64)] = np.frombuffer(r["best"]["weights"], dtype=np.float64)
    return vectors


def _centres(packed: DataFrame, idf: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """:func:`cluster` for all texts of every language: seeds lie far from each other, then each round assigns all texts
    anew, until no centroid moves, or ``ROUNDS`` times."""
    means = {lang: _unit(sums) for lang, (sums, _) in _sums(packed, idf, 1).items()}
    centres = {lang: seed[None] for lang, seed in _extremes(packed, idf, means, far=False).items()}
    for _ in range(1, k):
        for lang, seed in _extremes(packed, idf, centres, far=True).items():
            if np.abs(centres[lang] - seed).max(axis=1).min() > 0:  # fewer different texts than seeds
                centres[lang] = np.vstack([centres[lang], seed])
    moving = set(centres)
    for _ in range(ROUNDS):
        if not moving:
            break
        for lang, (sums, n) in _sums(packed.filter(F.col("lang").isin(*moving)), idf, k, {own: centres[own] for own in moving}).items():
            before = centres[lang]
            centres[lang] = np.where((n > 0)[:len(before), None], _unit(sums[:len(before)]), before)
            if np.abs(centres[lang] - before).max() < STILL:
                moving.discard(lang)
    return centres


def _lowest(train: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray], lowest: float, bits: int) -> dict:
    """By language and size bin, the quantile ``lowest`` of the cosines of all texts and excerpts, where there are enough of them."""
    shared = train.sparkSession.sparkContext.broadcast((idf, centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        idf, centres = shared.value
        totals: dict[str, np.ndarray] = {}

        def count(lang: str, parts: list[str]) -> None:
            sizes, found, times = grams(parts, bits)
            sizes = sizes[sizes > 0]
            if len(sizes):
                weights, starts = _unit_rows(sizes, found, times, idf)
                steps = (_near(weights, starts, found, centres[lang]).max(axis=0).clip(0, 1) * (GRID - 1)).astype(np.int64)
                if lang not in totals:
                    totals[lang] = np.zeros(BINS * GRID, dtype=np.int64)
                np.add.at(totals[lang], _size_bins(sizes) * GRID + steps, 1)

        for batch in batches:
            held: dict[str, list[str]] = {}
            chars: dict[str, int] = {}
            for t, own in zip(column(batch, "text"), column(batch, "lang")):
                if t and own in centres:
                    for part in excerpts(t):
                        held.setdefault(own, []).append(part)
                        chars[own] = chars.get(own, 0) + len(part)
                        if chars[own] > PART_CHARS:
                            count(own, held.pop(own))
                            chars[own] = 0
            for own, parts in held.items():
                count(own, parts)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield {"lang": [lang] * len(at), "size": at // GRID, "step": at % GRID, "n": total[at]}

    steps = map_stream(train.select("text", "lang"), run, "lang string, size int, step int, n long").groupBy("lang", "size", "step").agg(F.sum("n").alias("n"))
    found = steps.groupBy("lang", "size").agg(F.sum("n").alias("n"), F.percentile("step", F.lit(lowest), F.col("n")).alias("low")).collect()
    shared.destroy()
    return {(r["lang"], r["size"]): r["low"] / (GRID - 1) for r in found if r["n"] >= EXAMPLES}  # at most BINS rows a language


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", centroids: int = CENTROIDS,
        bits: int = BITS, lowest: float = LOWEST) -> Model:
    """Learn from all rows that are not held out and whose ``lang`` is not null.

    Document frequencies, centroids and limits each come from all of these texts. The limit of a language depends on the
    number of different n-grams, as a clean text of a few words has few and so a small cosine: it is
    ``SPARE`` times the quantile ``lowest`` of the cosines of the texts and their excerpts
    of that size, in steps of 1 / ``GRID``. Sizes with fewer than ``EXAMPLES`` take the limit of the next smaller one, the
    smallest ``FLOOR``. Without any rows to learn from there is no language, and everything is
    undetermined.
    """
    train = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
             .filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))))
    packed = _packed(train, bits)

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen, n = np.zeros(1 << bits, dtype=np.int64), 0
        for _, sizes, found, _ in _unpacked(batches):
            seen += np.bincount(found, minlength=1 << bits)
            n += len(sizes)
        at = np.flatnonzero(seen)
        yield {"gram": np.r_[-1, at], "n": np.r_[n, seen[at]]}

    summed = map_stream(packed, frequency, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    found = {r["gram"]: r["n"] for r in summed}  # at most 2 ** bits + 1 rows
    idf = np.zeros(1 << bits)
    for gram in range(1 << bits):
        idf[gram] = np.log((1 + found.get(-1, 0)) / (1 + found.get(gram, 0))) + 1
    if len(packed.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    learnt = [(own, sorted(map(tuple, rows))) for own, rows in sorted(_centres(packed, idf, centroids).items())]
    languages = [own for own, rows in learnt for _ in rows]
    matrix = np.array([row for _, rows in learnt for row in rows]) if learnt else np.zeros((0, 1 << bits))
    low = _lowest(train, idf, {own: np.array(rows) for own, rows in learnt}, lowest, bits) if learnt else {}
    accepts = np.full((len(languages), BINS), FLOOR)
    for i, own in enumerate(languages):
        for size in range(BINS):
            accepts[i, size] = max(FLOOR, SPARE * low[own, size] if (own, size) in low else accepts[i, size - 1] if size else FLOOR)
    return Model(idf, languages, matrix, accepts)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row of ``docs``.

    ``lang_pred`` is the language of the centroid with the largest cosine, the first one in
    order if several are as near; ``score`` is that cosine. A null text and one without a letter are
    undetermined with score 0. ``rejected`` also marks texts too far from the nearest centroid.
    Only the text decides; other columns are ignored. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_LANGUAGES

    def run(batch: pa.RecordBatch) -> dict:
        known, langs, scores, rejected = shared.value, [], [], []
        texts = column(batch, "text")
        for i in range(0, len(texts), 200):
            found = [counts(t, bits) for t in texts[i:i + 200]]
            none = np.zeros(1 << bits)
            near = np.stack([none if g is None else _weighted(g, known.idf) for g in found]) @ known.centroids.T
            for grams, row in zip(found, near):
                if grams is None or not len(row):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                best = int(row.argmax())
                langs.append(known.languages[best])
                scores.append(float(min(1.0, max(0.0, row[best]))))
                rejected.append(bool(row[best] < known.accepts[best, size_bin(grams)]))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": langs, "score": scores,
                "rejected": rejected}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accept(docs: DataFrame, model: Model, text: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("boolean")
    def stays(texts: pa.Array) -> pa.Array:
        known, out = shared.value, []
        for t in texts.to_pylist():
            grams = counts(t, bits)
            if grams is None or not len(known.languages):
                out.append(False)
                continue
            near = known.centroids @ _weighted(grams, known.idf)
            best = int(near.argmax())
            out.append(bool(near[best] >= known.accepts[best, size_bin(grams)]))
        return pa.array(out, pa.bool_())

    return docs.filter(stays(docs[text]))
