"""Hard-negative mining: rotated one-bit codes with certain intervals decide which pairs are scored in whole numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.batches import map_batches
from smogline.session import cut

POSITIVES = 5
NEGATIVES = 5
#: A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 80, 100
ANCHORS = 2048
ROWS = 16384
STEP = 2048
PLANES = 8
SEED = 42
#: Share of the norms' product by which intervals are widened against rounding.
SLACK = 1e-9
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of integer ``vectors``: sign bits after the rotation, their alignment, and the residual's length.

    The code stands for the unit vector c of signs over the root of the dimension. The alignment
    is the inner product of the rotated vector with c; the rest of the vector is at right angles to c.
    """
    turned = vectors.astype(np.float64) @ rotation(vectors.shape[1])
    along = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return _words(turned > 0), along, np.sqrt(np.maximum(0, np.einsum("ij,ij->i", turned, turned) - along * along))


class Query:
    """A rotated vector, cut into bit planes so that its inner product with a code is a few popcounts."""

    def __init__(self, vector: np.ndarray, planes: int = PLANES):
        turned = vector.astype(np.float64) @ rotation(len(vector))
        self.dim, self.norm = len(vector), float(np.sqrt(turned @ turned))
        self.low, width = float(turned.min()), float(np.ptp(turned)) / ((1 << planes) - 1)
        self.width = width if width > 0 else 1.0
        grid = np.rint((turned - self.low) / self.width).astype(np.int64)
        self.error = float(np.linalg.norm(turned - (self.low + grid * self.width)))
        self.planes = [_words(((grid >> j) & 1).astype(bool)[None])[0] for j in range(planes)]
        self.sum = int(grid.sum())

    def interval(self, codes: np.ndarray, along: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds that surely hold the inner products with the coded vectors.

        With v = a c + e the product is a <c, q> + <e, q>. The first part comes from popcounts of
        the code with each plane, off by at most the length of q's rounding error (c has length 1).
        e is at right angles to c, so by Cauchy and Schwarz the second part is at most |e|
        times the length of what q has beside c.
        """
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        common = sum((np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j) for j, plane in enumerate(self.planes))
        # signs are 2 b - 1: twice what set bits add up to, less the whole sum
        inner = (self.width * (2 * common - self.sum) + self.low * (2 * ones - self.dim)) / np.sqrt(self.dim)
        beside = np.sqrt(np.maximum(0, self.norm ** 2 - np.maximum(0, np.abs(inner) - self.error) ** 2))
        spread = np.abs(along) * self.error + rest * beside + SLACK * self.norm * (np.abs(along) + rest) + SLACK
        return along * inner - spread, along * inner + spread


def scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers; beyond 64 bits they stay at the largest or smallest long."""
    if not len(vectors):
        return np.zeros(0, dtype=np.int64)
    most = float(np.abs(vectors).max()) * float(np.abs(query).max()) * len(query)
    if most < 2 ** 53:  # every partial sum is a whole number that a double holds
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = vectors.astype(object) @ query.astype(object)
    return np.array([min(max(int(s), _LEAST), _MOST) for s in exact], dtype=np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    return np.lexsort((ids, ~score))[:k]


def prepare(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label") -> DataFrame:
    """vec_id, label, v (components floor(256 x) as longs) and node of the rows that take part.

    Rows with a null label, a null or empty vector, or a null or non-finite component are left out, and so
    are components beyond the range of longs. Rows that repeat another in id, label and
    vector count once.
    """
    values = F.col(embedding).cast("array<double>")
    label = F.col(label) if isinstance(label, str) else label
    sound = (label.isNotNull() & values.isNotNull() & (F.size(values) > 0)
             & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 54))))
    rows = (vectors.filter(F.coalesce(sound, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.transform(values, lambda x: F.floor(x * 256.0).cast("long")).alias("v"))
            .dropDuplicates(["vec_id", "label", "v"]))
    return cut(rows.withColumn("node", F.monotonically_increasing_id()))


def _coded(rows: DataFrame) -> DataFrame:
    """``rows`` with code, along and rest."""

    def run(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        code, along, rest = np.empty(n, dtype=object), np.zeros(n), np.zeros(n)
        for at, matrix in _by_length(batch.column("v")):
            words, along[at], rest[at] = encode(matrix)
            code[at] = [w.tobytes() for w in words]
        return {**{c: batch.column(c) for c in ("node", "vec_id", "label", "v")}, "code": code.tolist(), "along": along, "rest": rest}

    return map_batches(rows.select("node", "vec_id", "label", "v"), run,
                       "node long, vec_id long, label long, v array<long>, code binary, along double, rest double")


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    values = column.flatten().to_numpy()
    lengths = pa.compute.list_value_length(column).to_numpy()
    bounds = np.r_[0, np.cumsum(lengths)]
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield at, values[bounds[at][:, None] + np.arange(dim)]


class _Tile:
    """The rows of a tile, those of one length as matrices."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.ids = table.column("vec_id").to_pylist()
        self.order = np.array([_MOST if i is None else i for i in self.ids], dtype=np.int64)
        self.node, self.label = table.column("node").to_numpy(), table.column("label").to_numpy()
        self.lengths = pa.compute.list_value_length(table.column("v")).to_numpy()
        codes = table.column("code").to_pylist()
        self.parts = {}
        for at, matrix in _by_length(table.column("v").combine_chunks()) if table.num_rows else ():
            words = np.frombuffer(b"".join(codes[i] for i in at), dtype=np.uint64).reshape(len(at), -1)
            self.parts[matrix.shape[1]] = at, matrix, words, table.column("along").to_numpy()[at], table.column("rest").to_numpy()[at]


def _positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``k`` best rows of an anchor's label within a tile."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        tile = _Tile(rows)
        for anchor in anchors.to_pylist():
            vector = np.array(anchor["v"], dtype=np.int64)
            if len(vector) not in tile.parts:
                continue
            at, matrix, codes, along, rest = tile.parts[len(vector)]
            mine = np.flatnonzero((tile.label[at] == anchor["label"]) & (tile.node[at] != anchor["node"]))
            _, high = Query(vector).interval(codes[mine], along[mine], rest[mine])
            best, score, least = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), -np.inf
            for some in np.array_split(np.argsort(-high, kind="stable"), -(-len(mine) // STEP) or 1):
                some = mine[some[high[some] >= least]]
                found = np.r_[score, scores(matrix[some], vector)]
                both = np.r_[best, some]
                keep = _best(found, tile.order[at[both]], k)
                best, score = both[keep], found[keep]
                least = float(score[-1]) if len(score) == k else -np.inf
            out += [(anchor["node"], anchor["vec_id"], tile.ids[i], int(tile.node[i]), int(s)) for i, s in zip(at[best], score)]
        return _table(out, ("anchor", "anchor_id", "id", "node", "score"))

    return run


def _negatives(k: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each of an anchor's positives, the ``k`` best rows of other labels within a tile whose scores are in its window."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        tile = _Tile(rows)
        for anchor in anchors.to_pylist():
            vector = np.array(anchor["v"], dtype=np.int64)
            if len(vector) not in tile.parts:
                continue
            at, matrix, codes, along, rest = tile.parts[len(vector)]
            other = np.flatnonzero(tile.label[at] != anchor["label"])
            floor, top = Query(vector).interval(codes[other], along[other], rest[other])
            exact = np.zeros(len(other), dtype=np.int64)
            known = np.zeros(len(other), dtype=bool)
            for positive in anchor["positives"]:
                p = positive["score"]
                if p < 0:
                    continue  # the window is empty
                window = np.flatnonzero((top >= low * p / 100 - 1) & (floor <= high * p / 100 + 1))
                window = window[np.argsort(-np.minimum(top[window], high * p / 100), kind="stable")]
                best, score, least = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), -np.inf
                for some in np.array_split(window, -(-len(window) // STEP) or 1):
                    some = some[top[some] >= least]
                    new = some[~known[some]]
                    exact[new], known[new] = scores(matrix[other[new]], vector), True
                    some = some[[low * p <= 100 * s <= high * p for s in exact[some].tolist()]] if len(some) else some
                    both = np.r_[best, some]
                    keep = _best(exact[both], tile.order[at[other[both]]], k)
                    best, score = both[keep], exact[both[keep]]
                    least = float(score[-1]) if len(score) == k else -np.inf
                out += [(anchor["node"], anchor["vec_id"], positive["node"], positive["id"], p, tile.ids[i], int(tile.node[i]), int(s))
                        for i, s in zip(at[other[best]], score)]
        return _table(out, ("anchor", "anchor_id", "positive", "positive_id", "positive_score", "id", "node", "score"))

    return run


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _tiles(anchors: DataFrame, rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` over blocks of anchors against blocks of rows, each pair of blocks once."""
    count = anchors.count(), rows.count()
    across, down = max(1, -(-count[0] // ANCHORS)), max(1, -(-count[1] // ROWS))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    lot = F.xxhash64("node", F.lit(5))
    a = anchors.withColumn("x", F.pmod(lot, F.lit(across)).cast("int")).withColumn("y", numbers(down))
    r = rows.withColumn("y", F.pmod(lot, F.lit(down)).cast("int")).withColumn("x", numbers(across))
    return a.groupBy("x", "y").cogroup(r.groupBy("x", "y")).applyInArrow(run, schema)


def _first(rows: DataFrame, group: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of a group with their rank; every tile has sent at most ``k``."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "node")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by ``every``; all rows are searched. A score is the inner
    product of the vectors' components floor(256 x), exact as long as it fits a long and held at the limits of
    longs beyond. An anchor's positives are its first ``positives`` other rows of its label, by score
    descending, then id; for each, the first ``negatives`` rows of other labels in the same order
    whose score is from ``low`` to ``high`` hundredths of the positive's are returned, ranked from 1. A
    negative positive score has an empty window.

    Rows with a null label, a null or empty vector, a null, non-finite or huge component (beyond 2**54) take no part. A null id
    is no anchor and comes last among ties. Rows equal in id, label and vector count once; rows that share an id
    but differ are different rows. Vectors of different lengths do not meet. An empty table gives no rows,
    other columns are ignored.

    Anchors and rows are dealt in blocks, each pair of blocks is one task's work and hands on at most ``k`` rows per
    anchor (and positive); a label with most rows is spread over all blocks.
    """
    coded = cut(_coded(prepare(vectors, vec_id, embedding, label)))
    anchors = coded.filter(F.col("vec_id") % every == 0).select("node", "vec_id", "label", "v")
    near = _tiles(anchors, coded, _positives(positives), "anchor long, anchor_id long, id long, node long, score long")
    chosen = cut(_first(near, ["anchor"], positives))
    lists = chosen.groupBy("anchor").agg(F.collect_list(F.struct("id", "node", "score")).alias("positives"))
    asked = cut(anchors.join(lists, anchors["node"] == lists["anchor"]).select("node", "vec_id", "label", "v", "positives"))
    found = _tiles(asked, coded, _negatives(negatives, low, high),
                   "anchor long, anchor_id long, positive long, positive_id long, positive_score long, id long, node long, score long")
    ranked = _first(found, ["anchor", "positive"], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score"))
