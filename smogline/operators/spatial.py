"""Sensors in space: distinct places, nearest neighbours, regions of points."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.geo import haversine_km, sensor_key
from smogline.functions.values import quoted
from smogline.operators.joins import lookup_join
from smogline.schema import SENSOR
from smogline.session import cut

AXES = ("x", "y", "z")
FINEST = 21
FIRST_LEVEL = 3
LEVEL_STEP = 2
LEAF_ROWS = 8192
BLOCK, WIDE = 256, 8192


def distinct_sensors(df: DataFrame, keys=SENSOR, lat: str = "locationLatitude",
                     lon: str = "locationLongitude") -> DataFrame:
    """Distinct sensor and coordinate combinations with the composite key."""
    return (df.select(*keys, quoted(lat).alias("lat"), quoted(lon).alias("lon")).distinct()
            .withColumn("key", sensor_key(keys)))


def _cell(prefix: str, level: int, source: str = "f") -> list[Column]:
    return [F.shiftright(f"{source}{a}", FINEST - level).alias(f"{prefix}{a}") for a in AXES]


def _names(prefix: str) -> list[str]:
    return [f"{prefix}{a}" for a in AXES]


def _places(sensors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """One sensor per row with its place, and the sensors of each place that can be
    somebody's neighbour.

    Ties go to the smaller key, so of the sensors sharing a place only the ``k + 1``
    smallest keys can be among anybody's ``k`` nearest; the row-number filter is applied
    before the shuffle, so a crowded place sends ``k + 1`` rows per task.
    """
    one = (sensors.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
           .groupBy("key").agg(F.min(F.struct("lat", "lon")).alias("p"))
           .select("key", (F.col("p.lat") + 0.0).alias("lat"), (F.col("p.lon") + 0.0).alias("lon")))
    smallest = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("key"))
    kept = one.withColumn("_rn", smallest).filter(F.col("_rn") <= k + 1).drop("_rn")
    return one, kept


def _on_grid(kept: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Places in space, their cells in the finest grid, and the extent along each axis.

    Places are points of the unit sphere; straight-line distance there grows with the
    great-circle distance, and there is no seam at the date line or the poles. The axes
    are turned so that the third points to the middle of all places: for a network of one
    city or country the grid is then nearly flat.
    """
    lat, lon = F.radians("lat"), F.radians("lon")
    # Written once: the cells below must all be computed from the very same coordinates.
    ball = cut(kept.select("*", (F.cos(lat) * F.cos(lon)).alias("bx"), (F.cos(lat) * F.sin(lon)).alias("by"),
                           F.sin(lat).alias("bz")))
    found = ball.agg(*[f(f"b{a}").alias(f"{n}_{a}") for a in AXES for n, f in (("mid", F.avg), ("lo", F.min), ("hi", F.max))],
                     F.count("*").alias("rows")).first()
    middle = {a: found[f"mid_{a}"] or 0.0 for a in AXES}
    size = math.sqrt(sum(v ** 2 for v in middle.values()))
    up = [middle[a] / size for a in AXES] if size > 1e-6 else [0.0, 0.0, 1.0]
    flat = math.hypot(up[0], up[1])
    east = [-up[1] / flat, up[0] / flat, 0.0] if flat > 1e-9 else [1.0, 0.0, 0.0]
    north = [up[1] * east[2] - up[2] * east[1], up[2] * east[0] - up[0] * east[2], up[0] * east[1] - up[1] * east[0]]
    # The corners of the box before turning bound the coordinates after it.
    sides = [(found[f"lo_{a}"] or 0.0, found[f"hi_{a}"] or 0.0) for a in AXES]
    box = {"rows": found["rows"]}
    for a, direction in zip(AXES, (east, north, up)):
        ends = [sorted((lo * w, hi * w)) for (lo, hi), w in zip(sides, direction)]
        box[f"lo_{a}"], box[f"hi_{a}"] = sum(e[0] for e in ends), sum(e[1] for e in ends)
    points = ball.select(*kept.columns, *[
        sum((F.col(f"b{b}") * w for b, w in zip(AXES, direction)), F.lit(0.0)).alias(a)
        for a, direction in zip(AXES, (east, north, up))])
    low = {a: box[f"lo_{a}"] for a in AXES}
    extent = {a: box[f"hi_{a}"] - low[a] for a in AXES}
    width = max(*extent.values(), 1e-9) * (1 + 1e-9)
    top = (1 << FINEST) - 1
    cells = [F.greatest(F.least(F.floor((F.col(a) - low[a]) / width * (1 << FINEST)), F.lit(top)), F.lit(0))
             .cast("int").alias(f"f{a}") for a in AXES]
    return points.select("*", *cells), {**extent, "width": width, "rows": box["rows"]}


def nearest_neighbors(sensors: DataFrame, k: int = 3, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The ``k`` nearest other sensors of each sensor: ``key1, key2, dist_km, rn``.

    ``sensors`` has ``key, lat, lon``; a sensor listed with several coordinates counts at
    the smallest. Order is by distance, then key. The result is exact and no all-pairs
    join happens: pairs of grid cells are refined from coarse to fine. At each level a
    cell drops partners that are farther than partners already holding ``k + 1`` sensors,
    and once a cell's partners hold few sensors their points are compared. Levels that
    cannot be fine enough, going by the number of places, are passed in one plan; only cells
    that are still crowded then go on level by level. Any crowding is met by finer cells,
    and sensors at one place are handled as one place.
    """
    one, kept = _places(sensors, k)
    points, extent = _on_grid(kept)
    q, c = _names("q"), _names("c")
    root = ", ".join(f"{name} int" for name in [*q, *c])
    pairs = points.sparkSession.createDataFrame([(0,) * 6], root)
    found = []
    if extent["rows"] <= leaf_rows:
        whole = pairs.withColumn("_reach", F.lit(None).cast("double"))
        return _per_sensor(one, _compare(points, whole, 0, k), k)
    # Evenly spread over a plane, a cell's 25 or so partners hold few enough rows from this level on.
    enough = math.log(25 * extent["rows"] / leaf_rows, 4)
    # Cells of one level are the parents of the next; the first level has 8 cells per axis.
    for level in range(FIRST_LEVEL, FINEST + 1, LEVEL_STEP):
        step = FIRST_LEVEL if level == FIRST_LEVEL else LEVEL_STEP
        cells = points.groupBy(*_cell("c", level)).agg(F.count("*").alias("n"))
        own = cells.select(*[F.col(f"c{a}").alias(f"q{a}") for a in AXES],
                           *[F.shiftright(f"c{a}", step).alias(f"pq{a}") for a in AXES])
        other = cells.select("*", *[F.shiftright(f"c{a}", step).alias(f"pc{a}") for a in AXES])
        pairs = (pairs.select(*[F.col(n).alias(f"p{n}") for n in [*q, *c]])
                 .join(own, _names("pq")).join(other, _names("pc")).select(*q, *c, "n"))
        side = extent["width"] / (1 << level)
        apart = {a: F.abs(F.col(f"q{a}") - F.col(f"c{a}")).cast("double") for a in AXES}
        low = sum((F.pow(F.greatest(d - 1, F.lit(0.0)) * side, 2) for d in apart.values()), F.lit(0.0))
        high = sum((F.pow(F.least((d + 1) * side, F.lit(extent[a])), 2) for a, d in apart.items()), F.lit(0.0))
        partners = Window.partitionBy(*q)
        pairs = (pairs.withColumn("_low", low).withColumn("_high", high)
                 .withColumn("_cum", F.sum("n").over(partners.orderBy("_high")))
                 .withColumn("_reach", F.min(F.when(F.col("_cum") >= k + 1, F.col("_high"))).over(partners))
                 .filter(F.col("_reach").isNull() | (F.col("_low") <= F.col("_reach") * (1 + 1e-6)))
                 .withColumn("_rows", F.sum("n").over(partners))
                 .select(*q, *c, "_reach", "_rows"))
        if level < min(enough, FINEST - LEVEL_STEP):
            continue
        pairs = cut(pairs)
        size = pairs.agg(F.min("_rows").alias("least"), F.max("_rows").alias("most")).first()
        last = level + LEVEL_STEP > FINEST or (size["most"] or 0) <= leaf_rows
        if last or size["least"] <= leaf_rows:
            found.append(_compare(points, pairs if last else pairs.filter(F.col("_rows") <= leaf_rows), level, k))
        if last:
            break
        pairs = pairs.filter(F.col("_rows") > leaf_rows)
    return _per_sensor(one, reduce(DataFrame.unionByName, found), k)


def _per_sensor(one: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """From the ``k + 1`` nearest of each place to the ``k`` nearest others of each sensor."""
    lists = near.groupBy("lat", "lon").agg(F.collect_list(F.struct("dist_km", "key2")).alias("near"))
    pairs = (lookup_join(one.withColumnRenamed("key", "key1"), lists, ["lat", "lon"], "inner")
             .select("key1", F.slice(F.array_sort(F.filter(
                 "near", lambda n: n["key2"] != F.col("key1"))), 1, k).alias("near")))
    return pairs.select("key1", F.posexplode("near").alias("rn", "n")).select(
        "key1", F.col("n.key2").alias("key2"), F.col("n.dist_km").alias("dist_km"),
        (F.col("rn") + 1).cast("bigint").alias("rn"))


def _compare(points: DataFrame, pairs: DataFrame, level: int, k: int) -> DataFrame:
    """The ``k + 1`` nearest sensors of each place among the cells paired with its own.

    A cell's places and the sensors of its partners, at most some thousands unless many share
    a finest cell, meet in one group. There the squared straight distances are taken as matrices, part by
    part, and only sensors not farther than the ``k + 1``-th go on; distances on the sphere
    and the order by them are left to Spark.
    """
    q, c = _names("q"), _names("c")
    places = points.select("lat", "lon", *AXES, *_cell("q", level)).distinct()
    seen = ["key", "lat", "lon", *AXES]
    others = points.select(*[F.col(n).alias(f"{n}2") for n in seen], *_cell("c", level))
    near = pairs.select(*q, *c).join(others, c).select(*q, *[f"{n}2" for n in seen])

    def candidates(mine, theirs):
        import numpy as np
        import pyarrow as pa

        here = np.stack([mine.column(a).to_numpy() for a in AXES], axis=1)
        there = np.stack([theirs.column(f"{a}2").to_numpy() for a in AXES], axis=1)
        found = []
        for i in range(0, len(here), BLOCK) if len(there) else ():
            part = here[i:i + BLOCK]
            best = np.full((len(part), 0), 0.0)
            for j in range(0, len(there), WIDE):
                chord = sum((part[:, None, d] - there[None, j:j + WIDE, d]) ** 2 for d in range(3))
                best = np.sort(np.partition(np.c_[best, chord], min(k, best.shape[1] + chord.shape[1] - 1), axis=1)[:, :k + 1], axis=1)
            reach = best[:, -1] * (1 + 1e-6) + 1e-18
            for j in range(0, len(there), WIDE):
                chord = sum((part[:, None, d] - there[None, j:j + WIDE, d]) ** 2 for d in range(3))
                a, b = np.nonzero(chord <= reach[:, None])
                found.append((a + i, b + j))
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, dtype=np.int64)
        b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, dtype=np.int64)
        mine, theirs = mine.take(pa.array(a)), theirs.take(pa.array(b))
        return pa.table({"lat": mine.column("lat"), "lon": mine.column("lon"), "key2": theirs.column("key2"),
                         "lat2": theirs.column("lat2"), "lon2": theirs.column("lon2")})

    reached = places.groupBy(*q).cogroup(near.groupBy(*q)).applyInArrow(
        candidates, "lat double, lon double, key2 string, lat2 double, lon2 double")
    reached = reached.select("lat", "lon", "key2", haversine_km("lat", "lon", "lat2", "lon2").alias("dist_km"))
    rank = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("dist_km", "key2"))
    return reached.withColumn("_rn", rank).filter(F.col("_rn") <= k + 1).drop("_rn")


def neighbor_lists(neighbors: DataFrame) -> DataFrame:
    """One array per sensor, nearest first; at most ``k`` entries each."""
    return neighbors.groupBy("key1").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rn", "key2"))), lambda n: n["key2"]).alias("neighbors"))


def region_cells(edges: DataFrame, columns: list[str]) -> tuple[DataFrame, float, float]:
    """Regions cut into horizontal strips, each strip listed under the grid cells it spans.

    A strip holds the edges a horizontal ray inside it can meet. Strips are as many as
    the square root of the edges and columns as the square root of the regions, so a
    strip's list stays short however detailed the layer is.
    """
    size = edges.agg(F.count("*").alias("edges"), F.count_distinct("region_id").alias("regions"),
                     F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x9"),
                     F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("y1", "y2")).alias("y9")).first()
    tall = wide = 1.0
    if size["edges"]:
        tall = max((size["y9"] - size["y0"]) / size["edges"] ** 0.5, 1e-9)
        wide = max((size["x9"] - size["x0"]) / size["regions"] ** 0.5, 1e-9)
    strips = (
        edges.withColumn("gy", F.explode(F.sequence(
            F.floor(F.least("y1", "y2") / tall), F.floor(F.greatest("y1", "y2") / tall))))
        .groupBy("region_id", *columns, "gy")
        .agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_edges"),
             F.min(F.least("x1", "x2")).alias("_xmin"), F.max(F.greatest("x1", "x2")).alias("_xmax"))
        .withColumn("gx", F.explode(F.sequence(
            F.floor(F.col("_xmin") / wide), F.floor(F.col("_xmax") / wide))))
    )
    return strips.drop("region_id"), tall, wide


def _turn(e: Column, x: Column, y: Column) -> Column:
    """Positive when the point is left of the edge, zero when it is in line with it."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _meets_ray(e: Column, x: Column, y: Column) -> Column:
    """Does the ray to the right meet the edge; each edge owns its lower end only."""
    upward = (e["y1"] <= y) & (y < e["y2"]) & (_turn(e, x, y) > 0)
    downward = (e["y2"] <= y) & (y < e["y1"]) & (_turn(e, x, y) < 0)
    return upward | downward


def _lies_on(e: Column, x: Column, y: Column) -> Column:
    return ((_turn(e, x, y) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def assign_regions(points: DataFrame, edges: DataFrame, columns: list[str],
                   lon: str = "locationLongitude", lat: str = "locationLatitude") -> DataFrame:
    """Add the properties of the region holding each point.

    Points outside every region, or exactly on a border, keep nulls; a point in two
    overlapping regions appears twice. Even-odd counting over all rings makes holes and
    multipolygons work. Points are read once and meet only the strips of their own grid
    cell; adaptive execution splits a cell that holds many of them.
    """
    strips, tall, wide = region_cells(edges, columns)
    x, y = quoted(lon), quoted(lat)
    placed = points.withColumn("gx", F.floor(x / wide)).withColumn("gy", F.floor(y / tall))
    strips = strips.select(*[F.col(c).alias(f"_r_{c}") for c in columns], "_edges", "_xmin", "_xmax", "gx", "gy")
    strips = strips.withColumnsRenamed({c: f"_s_{c}" for c in ("gx", "gy")})
    inside = (F.size(F.filter("_edges", lambda e: _meets_ray(e, x, y))) % 2 == 1) \
        & ~F.exists("_edges", lambda e: _lies_on(e, x, y))
    joined = placed.join(
        strips, (F.col("gx") == F.col("_s_gx")) & (F.col("gy") == F.col("_s_gy"))
        & x.between(F.col("_xmin"), F.col("_xmax")) & inside, "left")
    return joined.select(*[quoted(c) for c in points.columns],
                         *[F.col(f"_r_{c}").alias(c) for c in columns])
