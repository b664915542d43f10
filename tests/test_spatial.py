import math
import random

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from smogline.operators import joins, spatial

PLACES = "key string, lat double, lon double"


def km(a, b):
    (la, lo), (lb, lp) = ([math.radians(v) for v in p] for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(min(h, 1)), math.sqrt(max(1 - h, 0)))


def nearest(points, k):
    """Distances only: symmetric layouts have ties that differ in the last digit."""
    out = {}
    for key, la, lo in points:
        far = sorted((km((la, lo), (lb, lp)), other) for other, lb, lp in points if other != key)
        out[key] = [round(d, 6) for d, _ in far[:k]]
    return out


def found(spark, points, k, leaf):
    got = spatial.nearest_neighbors(spark.createDataFrame(points, PLACES), k, leaf).orderBy("key1", "rn").collect()
    out = {p[0]: [] for p in points}
    for r in got:
        assert r["key1"] != r["key2"] and r["rn"] == len(out[r["key1"]]) + 1
        out[r["key1"]].append(round(r["dist_km"], 6))
    return out


def test_golden_line(spark):
    points = [(f"k{i}", 0.0, float(i)) for i in range(4)]
    nn = spatial.nearest_neighbors(spark.createDataFrame(points, PLACES), 2)
    lists = {r["key1"]: r["neighbors"] for r in spatial.neighbor_lists(nn).collect()}
    assert lists["k0"] == ["k1", "k2"] and lists["k1"] == ["k0", "k2"]


def clustered(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            p = (r.uniform(-90, 90), r.uniform(-180, 180))
        elif kind == 1:
            p = (41 + r.uniform(0, 0.001), -87 + r.uniform(0, 0.001))
        elif kind == 2:
            p = (r.choice([10.0, 89.9]), r.choice([179.9, -179.9]) + r.uniform(0, 0.05))
        else:
            p = (50.0, 8.0)  # a quarter of all sensors at one place
        out.append((f"k{i:04d}", *p))
    return out


@pytest.mark.parametrize("k,leaf", [(3, 512), (3, 20), (1, 8)])
def test_nearest_brute_force(spark, k, leaf):
    points = clustered(400, 2)
    assert found(spark, points, k, leaf) == nearest(points, k)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_sensors(spark, n):
    points = [(f"k{i}", float(i), 0.0) for i in range(n)]
    assert found(spark, points, 3, 512) == nearest(points, 3)


def test_same_place_ties_go_to_the_smaller_key(spark):
    points = [(f"k{i}", 1.0, 1.0) for i in range(6)]
    lists = spatial.neighbor_lists(spatial.nearest_neighbors(spark.createDataFrame(points, PLACES), 2))
    got = {r["key1"]: r["neighbors"] for r in lists.collect()}
    assert got == {"k0": ["k1", "k2"], "k1": ["k0", "k2"], **{f"k{i}": ["k0", "k1"] for i in range(2, 6)}}


EDGES = "region_id string, name string, x1 double, y1 double, x2 double, y2 double"


def ring(region, points, reverse=False):
    points = points[::-1] if reverse else points
    return [(region, f"R{region}", *a, *b) for a, b in zip(points, points[1:] + points[:1])]


def square(x, y, size):
    return [(float(x), float(y)), (x + size, float(y)), (x + size, y + size), (float(x), y + size)]


def regions_of(spark, edges, points):
    p = spark.createDataFrame([(i, float(x) if x is not None else None, float(y)) for i, (x, y) in enumerate(points)],
                              "i int, lon double, lat double")
    return rows(spatial.assign_regions(p, spark.createDataFrame(edges, EDGES), ["name"], "lon", "lat"), "i", "name")


def test_holes_borders_and_overlaps(spark):
    holed = ring("1", square(0, 0, 4.0)) + ring("1", square(1, 1, 2.0))
    points = [(0.5, 0.5), (2, 2), (5, 5), (0, 2), (1, 2), (None, 2), (0, 0), (2, 4)]
    expected = [(0, "R1")] + [(i, None) for i in range(1, 8)]
    assert regions_of(spark, holed, points) == expected
    back = ring("1", square(0, 0, 4.0), True) + ring("1", square(1, 1, 2.0), True)
    assert regions_of(spark, back, points) == expected
    both = ring("1", square(0, 0, 4.0)) + ring("2", square(3, 3, 4.0))
    assert regions_of(spark, both, [(3.5, 3.5)]) == [(0, "R1"), (0, "R2")]


def inside(polygon, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(polygon, polygon[1:] + polygon[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), corners=st.integers(3, 40))
def test_star_polygons_brute_force(spark, seed, corners):
    r = random.Random(seed)
    polygon = []
    for i in range(corners):
        a, d = 2 * math.pi * i / corners, r.uniform(0.2, 3)
        polygon.append((d * math.cos(a), d * math.sin(a)))
    points = [(r.uniform(-3, 3), r.uniform(-3, 3)) for _ in range(200)]
    expected = sorted(((i, "R1" if inside(polygon, *p) else None) for i, p in enumerate(points)), key=repr)
    assert regions_of(spark, ring("1", polygon), points) == expected
    assert regions_of(spark, ring("1", polygon, True), points) == expected


def test_no_regions(spark):
    assert regions_of(spark, [], [(1, 1)]) == [(0, None)]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_hot_keys_join_alike(spark, how):
    left = spark.createDataFrame([(i, None if i % 10 == 0 else i % 3 and 7) for i in range(300)], "i int, k int")
    right = spark.createDataFrame([(7, "a"), (7, "b"), (1, "c"), (None, "d")], "k int, v string")
    assert rows(joins.lookup_join(left, right, ["k"], how)) == rows(left.join(right, ["k"], how))


def test_a_hot_key_is_split_by_its_size(spark):
    """A key with nearly all rows is read by many tasks, each within the wanted size."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 400_000, numPartitions=40).select(F.when(F.col("id") % 50 > 0, 7).otherwise(F.col("id")).alias("k"), F.rand(1).alias("x"))
        right = spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        joined = joins.lookup_join(left, right, ["k"], "left").withColumn("task", F.spark_partition_id())
        tasks = joined.filter("k = 7").groupBy("task").count().collect()
        assert sum(r["count"] for r in tasks) == 392_000
        assert len(tasks) >= 3 and max(r["count"] for r in tasks) < 392_000 * 0.4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_layers_do_not_multiply_the_readings(spark, folder):
    from checks import tables
    from smogline.plans.locations import build_locations
    from smogline.sources.boundaries import LAYERS, flatten_datasources

    wards = tables.regions(spark, folder)
    layers = {name: wards.select("region_id", "x1", "y1", "x2", "y2", *[F.col("ward").alias(c) for c in columns.values()])
              for name, columns in LAYERS.items()}
    source = flatten_datasources(tables.datasources(spark, folder))
    for n in (0, 1, 3):
        built = build_locations(tables.wide(spark, folder), source, dict(list(layers.items())[:n]), ["event_id"])
        # the sensors are read from where they were written, the events by the metadata alone
        assert built._jdf.queryExecution().executedPlan().toString().count("events.parquet") == 1


def test_no_cross_joins(spark, folder):
    from checks import tables

    nn = spatial.nearest_neighbors(tables.places(spark, folder), 3)
    located = spatial.assign_regions(tables.places(spark, folder), tables.regions(spark, folder), ["ward"], "lon", "lat")
    for df in (nn, located):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
