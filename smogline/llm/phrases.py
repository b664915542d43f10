"""Phrase collocation mining by best-first growth with branch and bound."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.batches import column, map_stream
from smogline.llm.words import RUN_BYTES, coded, pack, texts_of, unpack
from smogline.session import cut

TOP = 2000
LEAST = 30
#: A candidate goes when a longer one around it has this many hundredths of its occurrences.
DROP = 80
WIDTH = 8 * TOP
#: Prefixes grown in one round, all languages together: what is sent to every task.
ROUND = 1 << 20
SALTS = 64
#: Words whose phrases are counted at once in a task.
SYMBOLS = 1 << 21
BREAK = b"\xff"
BITS = 31
_MASK = (1 << BITS) - 1
_CAPITALS = bytes(range(65, 91))
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_CAPITALS + _ENDS, _CAPITALS.lower() + BREAK * len(_ENDS))
KEY = ["w1", "w2", "w3"]
NONE = -1


def cut_words(text: bytes) -> list[bytes]:
    """Words at spaces and tabs, A-Z lower-cased, with a break where a piece ends."""
    return text.translate(_TABLE).replace(BREAK, b" \xff ").split()


def score(a: str, l: str, r: str) -> Column:  # noqa: E741 - the names of the columns
    """floor(2000000 a / (l + r)), exact: products are decimals of up to 38 digits."""
    return F.expr(f"cast({a} as decimal(20,0)) * 2000000 div (cast({l} as decimal(20,0)) + cast({r} as decimal(20,0)))")


def _top(rows: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group, ranked; a group is cut down in parts before its rows meet."""
    parts = Window.partitionBy(group, "_part").orderBy(*order)
    first = (rows.withColumn("_part", F.pmod(F.xxhash64(*KEY), F.lit(SALTS)))
             .withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= k))
    whole = Window.partitionBy(group).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k).drop("_part")


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id``: numbers without gaps."""
    words = cut(words.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = words.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()  # one row per partition
    if sum(r["n"] for r in sizes) > _MASK:
        raise OverflowError("more frequent words than 31 bits can number")
    ends = np.cumsum([r["n"] for r in sizes]).tolist()
    starts = words.sparkSession.createDataFrame([(r["p"], e - r["n"]) for r, e in zip(sizes, ends)], "p long, start long")
    return (words.join(F.broadcast(starts), part == F.col("p"))  # bounded by the number of partitions
            .select("space", "word", "f", (F.col("start") + place).alias("id")))


def _sequences(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The texts of all runs as numbers of frequent words; breaks and other words are -1, a row ends with one."""

    def put_back(texts: pa.Table, known: pa.Table) -> pa.Table:
        _, sizes, codes = texts_of(texts)
        names = np.full(int(codes.max()) + 1 if len(codes) else 0, NONE, dtype=np.int64)
        names[known.column("code").to_numpy()] = known.column("id").to_numpy()
        line = np.append(np.insert(names[codes], np.cumsum(sizes)[:-1], NONE), NONE)
        line = line[np.r_[True, (line[1:] >= 0) | (line[:-1] >= 0)]]
        gaps, rows, at = np.flatnonzero(line < 0) + 1, [], 0
        while at < len(line):
            end = gaps[min(np.searchsorted(gaps, at + (1 << 18)), len(gaps) - 1)]
            rows.append(line[at:end])
            at = int(end)
        return pa.table({"n": pa.array([len(r) for r in rows], pa.int32()), "line": pa.array([pack(r + 1) for r in rows], pa.binary())})

    return cut(texts.groupBy("run").cogroup(known.groupBy("run")).applyInArrow(put_back, "n int, line binary"))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The words of a task's rows, many rows at a time, each ended by -1."""
    held, size = [], 0
    for batch in batches:
        for n, line in zip(column(batch, "n"), column(batch, "line")):
            held.append(unpack(line, n).astype(np.int64) - 1)
            size += n
            if size >= SYMBOLS:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _tally(first: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of keys and how often each occurs."""
    order = np.lexsort((rest, first))
    first, rest = first[order], rest[order]
    start = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])][:len(first)])
    return first[start], rest[start], np.diff(np.r_[start, len(first)])


def _count_pairs(lines: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for w in _lines(batches):
            at = np.flatnonzero((w[:-1] >= 0) & (w[1:] >= 0))
            keys, n = np.unique(w[at] << BITS | w[at + 1], return_counts=True)
            yield {"w1": keys >> BITS, "w2": keys & _MASK, "n": n}

    return (map_stream(lines, run, "w1 long, w2 long, n long").groupBy("w1", "w2").agg(F.sum("n").alias("a"))
            .filter(F.col("a") >= least))


class Keys:
    """A set of 62-bit keys that large arrays are looked up in."""

    def __init__(self, keys: np.ndarray):
        self.sorted = np.unique(keys)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self._slot(self.sorted)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of every key in the set, -1 if it is not there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        at = np.flatnonzero(self.maybe[self._slot(keys)]) if len(self.sorted) else out[:0]
        place = np.minimum(np.searchsorted(self.sorted, keys[at]), max(len(self.sorted) - 1, 0))
        hit = self.sorted[place] == keys[at]
        out[at[hit]] = place[hit]
        return out


def _count_longer(lines: DataFrame, grown: pa.Table, least: int) -> DataFrame:
    """Phrases that are one word longer, at either end, than those of ``grown``: w1 to w4 and a."""
    w1, w2, w3 = (grown.column(c).to_numpy() for c in KEY)
    pair, three = w1 << BITS | w2, w3 >= 0
    pairs, heads = Keys(pair[~three]), Keys(pair[three])
    threes = Keys(heads.find(pair[three]) << BITS | w3[three])
    shared = lines.sparkSession.sparkContext.broadcast((pairs, heads, threes))  # bounded by ROUND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pairs, heads, threes = shared.value
        for w in _lines(batches):
            w = np.r_[w, NONE, NONE, NONE]
            at = np.flatnonzero((w[:-3] >= 0) & (w[1:-2] >= 0))
            pair = np.full(len(w), NONE, dtype=np.int64)
            pair[at] = w[at] << BITS | w[at + 1]
            grows = np.zeros(len(w), dtype=bool)
            grows[at] = pairs.find(pair[at]) >= 0
            at = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
            mine = at[grows[at] | grows[at + 1]]
            first, rest, n = _tally(pair[mine], w[mine + 2])
            yield {"w1": first >> BITS, "w2": first & _MASK, "w3": rest, "w4": np.full(len(n), NONE), "n": n}
            if not len(threes.sorted):
                continue
            grows = np.zeros(len(w), dtype=bool)
            head = heads.find(pair[at])
            at = at[head >= 0]
            grows[at] = threes.find(head[head >= 0] << BITS | w[at + 2]) >= 0
            at = np.flatnonzero((pair[:-2] >= 0) & (pair[1:-1] >= 0) & (pair[2:] >= 0))
            mine = at[grows[at] | grows[at + 1]]
            first, rest, n = _tally(pair[mine], pair[mine + 2])
            yield {"w1": first >> BITS, "w2": first & _MASK, "w3": rest >> BITS, "w4": rest & _MASK, "n": n}

    return (map_stream(lines, run, "w1 long, w2 long, w3 long, w4 long, n long").groupBy(*KEY, "w4").agg(F.sum("n").alias("a"))
            .filter(F.col("a") >= least))


def _scored(rows: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """``rows`` with l, r and score of the lowest-scoring cut, ties to the first one."""
    options = F.array(*[F.struct(score("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
                        for k, (l, r) in enumerate(cuts)])
    return (rows.withColumn("_cut", F.array_min(options))
            .select("space", *KEY, "w4", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score"),
                    "first", score("a", "first", "a").alias("bound")))


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def mine(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP, least: int = LEAST, drop: int = DROP,
         width: int = WIDTH, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n and score.

    Words, pieces, counts, candidates, scores and the rule that drops candidates inside longer ones
    are those of the module's contract: phrases of 2 to 4 words with a of at least ``least``, scored
    floor(2000000 a / (l + r)) at their lowest-scoring cut, ordered by score, a, phrase. A null language counts as
    "und", null texts as empty; repeated rows count as often as they occur, languages with fewer
    phrases give fewer, an empty table gives none, other columns are ignored. A very long text is a run of its own.

    Growth is best-first. A phrase that starts with the prefix p occurs at most f(p) times, and its cut after the first word w scores
    at most floor(2000000 f(p) / (f(w) + f(p))), as the rest is at least as frequent as the phrase: that is p's bound, and p's own score is
    not above it. Every round grows the prefixes with the highest bounds, at most ``width`` a
    language (twice as many in the next round): it counts what is one word longer at either end, which gives the
    longer candidates and settles whether the prefix itself is dropped (a phrase around it that is longer by
    more words implies one longer by one word). A language is done when no prefix left
    has a bound as high as its ``top``-th surviving score. Cutting a phrase of four words needs the count of its
    last three, so growing three words grows the last two of them as well.

    Words go by number once they are known to be frequent; a round reads the numbered texts and sends the prefixes to grow, at
    most ``ROUND``, to every task.
    """
    rows = docs.select(F.lit(None).cast("long").alias("id"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("space"),
                       F.col(text).cast("binary").alias("text"))
    found, texts = coded(rows, cut_words, run_bytes)
    found = found.filter(F.col("word") != F.lit(BREAK))
    totals = cut(found.groupBy("space").agg(F.sum("n").alias("n")))
    words = cut(_numbered(found.groupBy("space", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)))
    lines = _sequences(texts, found.join(words.select("space", "word", "id"), ["space", "word"]).select("run", "code", "id"))

    one, two = words.select(F.col("id").alias("w1"), "space", F.col("f").alias("first")), words.select(F.col("id").alias("w2"), F.col("f").alias("f2"))
    pairs = _count_pairs(lines, least).join(one, "w1").join(two, "w2").withColumn("w3", F.lit(NONE).cast("long")).withColumn("w4", F.col("w3"))
    known = [cut(_scored(pairs, [("first", "f2")]))]
    of_two = known[0].select("w1", "w2", F.col("a").alias("f"))
    width = max(1, min(width, ROUND // (2 * max(1, totals.count()))))

    grown: list[DataFrame] = []
    survivors: list[DataFrame] = []
    best = None
    while True:
        open_ = _all(known).filter(F.col("w4") == NONE)
        if grown:
            open_ = open_.join(_all(grown).select(*KEY), KEY, "left_anti")
            open_ = open_.join(best.groupBy("space").agg(F.count("*").alias("_n"), F.min("score").alias("_least")), "space", "left")
            open_ = open_.filter((F.coalesce("_n", F.lit(0)) < top) | (F.col("bound") >= F.col("_least"))).drop("_n", "_least")
        chosen = cut(_top(open_, "space", [F.col("bound").desc(), *KEY], width).drop("rank"))
        if chosen.isEmpty():
            break
        ends = chosen.filter(F.col("w3") != NONE).select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.lit(NONE).cast("long").alias("w3"))
        ends = ends.distinct().join(_all([*grown, chosen.select(*KEY)]), KEY, "left_anti")
        chosen = cut(chosen.unionByName(known[0].join(ends, KEY, "left_semi")))
        counted = cut(_count_longer(lines, chosen.select(*KEY).toArrow(), least))

        inside = counted.select("a", F.explode(F.array(
            F.struct("w1", "w2", F.when(F.col("w4") == NONE, NONE).otherwise(F.col("w3")).alias("w3")),
            F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.when(F.col("w4") == NONE, NONE).otherwise(F.col("w4")).alias("w3")))).alias("p"))
        most = inside.groupBy("p.w1", "p.w2", "p.w3").agg(F.max("a").alias("_most"))
        gone = F.col("_most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * drop
        settled = cut(chosen.join(most, KEY, "left").withColumn("_stays", ~F.coalesce(gone, F.lit(False))))

        heads = chosen.select(*KEY, "space", "first", F.col("a").alias("head"))
        three = (counted.filter(F.col("w4") == NONE).join(heads.filter(F.col("w3") == NONE).drop("w3"), ["w1", "w2"])
                 .join(of_two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("tail")), ["w2", "w3"])
                 .join(words.select(F.col("id").alias("w3"), F.col("f").alias("f3")), "w3"))
        three = cut(_scored(three, [("first", "tail"), ("head", "f3")]))
        known.append(three)
        of_three = _all(known[1:]).filter(F.col("w4") == NONE).select(
            F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), F.col("a").alias("tail"))
        four = (counted.filter(F.col("w4") != NONE).join(heads.filter(F.col("w3") != NONE), KEY).join(of_three, ["w2", "w3", "w4"])
                .join(of_two.select("w1", "w2", F.col("f").alias("half")), ["w1", "w2"])
                .join(of_two.select(F.col("w1").alias("w3"), F.col("w2").alias("w4"), F.col("f").alias("end")), ["w3", "w4"])
                .join(words.select(F.col("id").alias("w4"), F.col("f").alias("f4")), "w4"))
        four = cut(_scored(four, [("first", "tail"), ("half", "end"), ("head", "f4")]))

        grown.append(settled.select(*KEY))
        survivors += [settled.filter("_stays").select(*four.columns), four]
        scores = _all(survivors[-2:]).select("space", "score", *KEY)
        scores = scores if best is None else scores.unionByName(best)
        best = cut(_top(scores, "space", [F.col("score").desc()], top).drop("rank"))
        width = min(2 * width, max(width, ROUND // (2 * max(1, totals.count()))))

    if not survivors:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    kept = _all(survivors).join(best.groupBy("space").agg(F.count("*").alias("_n"), F.min("score").alias("_least")), "space")
    kept = kept.filter((F.col("_n") < top) | (F.col("score") >= F.col("_least")))
    for w in (*KEY, "w4"):
        kept = kept.join(words.select(F.col("id").alias(w), F.col("word").cast("string").alias(f"_{w}")), w, "left")
    kept = kept.withColumn("phrase", F.concat_ws(" ", *[f"_{w}" for w in (*KEY, "w4")]))
    ranked = _top(kept, "space", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return ranked.join(totals, "space").select(F.col("space").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                               "score")
