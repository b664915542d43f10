"""Embedding near-deduplication: randomised-rotation binary codes decide which pairs need exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.batches import map_batches
from smogline.llm.graph import components
from smogline.session import cut

THRESHOLD = 0.98
CELL_ROWS = 2048
PIVOT_BYTES = 64 << 20
HOMES = 2048
VISITORS = 16384
SLACK = 1e-5
SEED = 42


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation: the orthogonal part of a matrix of normal numbers."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of rotated unit vectors, packed, and the correction factor of each.

    The code stands for the corner of the cube that the vector points to; the factor is the
    cosine between the two.
    """
    return np.packbits(rotated > 0, axis=1), np.abs(rotated).sum(axis=1) / np.sqrt(rotated.shape[1])


def estimates(packed: np.ndarray, factor: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the cosines between coded vectors and rotated ``queries``, and upper bounds.

    With x = f c + sqrt(1 - f^2) e, where c is the code's corner and e is orthogonal to it, the
    cosine is f <c, q> + sqrt(1 - f^2) <e, q>. The random rotation makes <c, q> / f an unbiased
    estimate. As <e, q> is at most sqrt(1 - <c, q>^2), the bound holds with certainty, and no
    pair above a threshold is lost by it.
    """
    dim = queries.shape[1]
    corners = (np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    inner = (corners @ queries.astype(np.float32).T).astype(np.float64)
    f = factor[:, None]
    bound = f * inner + np.sqrt(np.maximum(0, 1 - f * f)) * np.sqrt(np.maximum(0, 1 - inner * inner))
    return inner / f, bound


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision."""
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the rows of each length in a list column."""
    values, bounds = column.flatten().to_numpy(), np.r_[0, np.cumsum(pa.compute.list_value_length(column).to_numpy())]
    lengths = np.diff(bounds)
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield at, values[bounds[at][:, None] + np.arange(dim)]


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unite what the pairs connect; every root points to itself."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if len(a):
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def _found(u, v, n) -> pa.Table:
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})


def _compare(threshold: float):
    """Home vectors of a cell against vectors that may be near one: links per home, and edges that connect them."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        at_home = rows.column("home").to_numpy()
        homes, visitors = rows.filter(pa.array(at_home)), rows.filter(pa.array(~at_home))
        if not homes.num_rows or not visitors.num_rows:
            return _found([], [], [])

        def matrix(side: pa.Table) -> np.ndarray:
            return side.column("vector").combine_chunks().flatten().to_numpy().reshape(side.num_rows, -1)

        x, y = matrix(homes), matrix(visitors)
        mine, theirs, weight = homes.column("node").to_numpy(), visitors.column("node").to_numpy(), visitors.column("weight").to_numpy()
        turned = _unit(y) @ rotation(y.shape[1])
        packed = np.frombuffer(b"".join(homes.column("code").to_pylist()), dtype=np.uint8).reshape(len(x), -1)
        factor = homes.column("factor").to_numpy()
        links, root = np.zeros(len(x), dtype=np.int64), np.arange(len(x) + len(y))
        for i in range(0, len(x), 256):
            for j in range(0, len(y), 4096):
                _, bound = estimates(packed[i:i + 256], factor[i:i + 256], turned[j:j + 4096])
                a, b = np.nonzero(bound >= threshold - SLACK)
                for k in range(0, len(a), 100_000):  # undecided by the codes: exact
                    p, q = a[k:k + 100_000] + i, b[k:k + 100_000] + j
                    near = (mine[p] != theirs[q]) & (cosines(x[p], y[q]) >= threshold)
                    p, q = p[near], q[near]
                    np.add.at(links, p, weight[q])
                    root = _merge(root, p, q + len(x))
        names = np.r_[mine, theirs]
        moved = np.flatnonzero(root != np.arange(len(root)))
        found = np.flatnonzero(links)
        return _found(np.r_[names[moved], mine[found]], np.r_[names[root[moved]], np.full(len(found), -1)],
                      np.r_[np.zeros(len(moved), dtype=np.int64), links[found]])

    return run


def _cells(nodes: DataFrame, threshold: float, cell_rows: int) -> DataFrame:
    """``nodes`` with cell and home: each vector once at home, and as a visitor wherever a link to it may be at home.

    Cells belong to pivots drawn from the vectors, about one in ``cell_rows``, fewer where all
    pivots together would pass ``PIVOT_BYTES``. A vector is at home with its nearest pivot. Any link of a
    home vector lies within the chord r of the threshold, so it is at most r beyond the plane
    between the two pivots, and at most r beyond the farthest home vector of the cell: vectors
    that pass both tests visit. Nothing else is left out, so no link is lost.
    """
    spark = nodes.sparkSession
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    every = max(cell_rows, -(-(size["n"] or 0) * (size["dim"] or 1) * 16 // PIVOT_BYTES))
    chosen = (nodes.filter(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(every)) == 0)
              .select("node", "space", "vector").orderBy("node").limit(2 * PIVOT_BYTES // (8 * (size["dim"] or 1))).collect())
    pivots: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for space in {r["space"] for r in chosen}:
        own = [r for r in chosen if r["space"] == space]
        pivots[space] = (np.array([r["node"] for r in own], dtype=np.int64), _unit(np.array([r["vector"] for r in own])))
    shared = spark.sparkContext.broadcast(pivots)
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6

    def distances(unit: np.ndarray, space: str) -> tuple[np.ndarray, np.ndarray]:
        ids, places = shared.value[space]
        return ids, np.sqrt(np.maximum(0, 2 - 2 * unit @ places.T))

    def by_space(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        spaces = np.array(batch.column("space").to_pylist(), dtype=object)
        for at, matrix in _rows(batch.column("vector")):
            for space in np.unique(spaces[at]):
                own = spaces[at] == space
                yield space, at[own], _unit(matrix[own])

    def settle(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        cell, far = np.full(n, -1, dtype=np.int64), np.zeros(n)
        code, factor = np.empty(n, dtype=object), np.zeros(n)
        for space, at, unit in by_space(batch):
            packed, own = codes(unit @ rotation(unit.shape[1]))
            code[at], factor[at] = [c.tobytes() for c in packed], own
            if space in shared.value:
                ids, away = distances(unit, space)
                nearest = away.argmin(axis=1)
                cell[at], far[at] = ids[nearest], away[np.arange(len(at)), nearest]
        return {**{c: batch.column(c) for c in ("node", "space", "vector", "weight")}, "cell": cell, "far": far, "code": code.tolist(),
                "factor": factor}

    settled = cut(map_batches(nodes, settle, "node long, space string, vector array<double>, weight long, cell long, far double, "
                                             "code binary, factor double"))
    radius = {r["cell"]: r["far"] for r in settled.filter("cell >= 0").groupBy("cell").agg(F.max("far").alias("far")).collect()}
    radii = spark.sparkContext.broadcast(radius)  # one number per pivot

    def visit(batch: pa.RecordBatch) -> dict:
        rows, cells = [], []
        for space, at, unit in by_space(batch):
            if space not in shared.value:
                rows.append(at)
                cells.append(np.full(len(at), -1, dtype=np.int64))
                continue
            ids, away = distances(unit, space)
            places = shared.value[space][1]
            nearest = away.argmin(axis=1)
            least = away[np.arange(len(at)), nearest]
            between = np.sqrt(np.maximum(0, 2 - 2 * places @ places.T))[nearest] if len(ids) <= 4096 else np.sqrt(
                np.maximum(0, 2 - 2 * places[nearest] @ places.T))
            beyond = (away ** 2 - least[:, None] ** 2) / (2 * np.maximum(between, 1e-9))
            limit = np.array([radii.value.get(i, -9.0) for i in ids])
            who, where = np.nonzero((beyond <= reach) & (away <= limit + reach))
            rows.append(at[who])
            cells.append(ids[where])
        at = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        return {**{c: batch.column(c).take(pa.array(at)) for c in ("node", "space", "vector", "weight")},
                "cell": np.concatenate(cells) if cells else at}

    visitors = map_batches(settled.select("node", "space", "vector", "weight"), visit,
                           "node long, space string, vector array<double>, weight long, cell long")
    homes = settled.select("node", "space", "vector", "weight", "cell", "code", "factor", F.lit(True).alias("home"))
    return homes.union(visitors.select("node", "space", "vector", "weight", "cell", F.lit(None).cast("binary").alias("code"),
                                       F.lit(None).cast("double").alias("factor"), F.lit(False).alias("home")))


def dedup(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
          threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``.

    Two rows link when their labels are equal and not null and the cosine of their vectors,
    in double precision, is at least ``threshold``. Vectors of different lengths, null, empty or
    zero vectors and those with null or non-finite components link with nothing. Equal vectors of one label
    are one node, however many rows share it, and count for each other's n_links. component_id
    is the smallest vec_id reachable by links; a null vec_id counts as larger than any. kept is
    vec_id = component_id (null-safe). An empty table gives no rows, other columns are ignored.

    Work is dealt in tiles of at most ``HOMES`` by ``VISITORS`` vectors of a cell, each of which
    hands on link counts and a spanning forest, never its pairs.
    """
    values = F.col(embedding).cast("array<double>")
    sound = (F.col(label).isNotNull() & values.isNotNull()
             & F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
             & F.exists(values, lambda x: x != 0))
    space = F.concat_ws(":", F.size(values).cast("string"), F.col(label).cast("string"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("vector"),
                          F.coalesce(sound, F.lit(False)).alias("sound"), space.alias("space"))
    rows = rows.withColumn("key", F.when(F.col("sound"), F.sha2(F.concat_ws(",", "space", F.col("vector").cast("array<string>")), 256)))
    nodes = cut(rows.filter("sound").groupBy("key").agg(
        F.first("space").alias("space"), F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("vec_id").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()))
    placed = _cells(nodes.select("node", "space", "vector", "weight"), threshold, cell_rows)
    counts = placed.groupBy("space", "cell").agg(F.sum(F.col("home").cast("long")).alias("h"), F.sum((~F.col("home")).cast("long")).alias("g"))
    tiles = counts.select("space", "cell", F.ceil(F.col("h") / HOMES).cast("int").alias("hs"), F.ceil(F.col("g") / VISITORS).cast("int").alias("vs"))
    lot = F.xxhash64("node", F.lit(3))
    dealt = (placed.join(tiles, ["space", "cell"])
             .withColumn("ht", F.explode(F.when(F.col("home"), F.array(F.pmod(lot, "hs").cast("int"))).otherwise(
                 F.sequence(F.lit(0), F.col("hs") - 1))))
             .withColumn("vt", F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("vs") - 1)).otherwise(
                 F.array(F.pmod(lot, "vs").cast("int"))))))
    found = cut(dealt.groupBy("space", "cell", "ht", "vt").applyInArrow(_compare(threshold), "u long, v long, n long"))
    links = found.filter("v < 0").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    linked = components(found.filter("v >= 0").select("u", "v"))
    named = (nodes.select("node", "key", "weight", "first").join(linked, "node", "left")
             .withColumn("component", F.coalesce("component", "node")).join(links, "node", "left"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(smallest, "component").select(
        F.col("key").alias("_key"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    return (rows.select("vec_id", "key", "sound").join(classes, F.col("key") == F.col("_key"), "left")
            .withColumn("component_id", F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id")))
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))
