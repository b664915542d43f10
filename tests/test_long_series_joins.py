from datetime import timedelta

from helpers import ZERO, rows, series
from pyspark.sql import functions as F

from smogline.operators import impute
from smogline.plans import cleaners
from smogline.schema import HUMIDITY_RAW, PM25_RAW, TEMPERATURE_RAW

#: What only joins of readings with readings are by.
OF_READINGS = ("_block", "_group", "_seg", "_pos", "_piece", "run#", "_at#", "_gap_id")


def minutes(spark):
    """Three sensors, one without a source, with lone gaps, linked ones, runs and flat stretches."""
    def value(i, n):
        if (i + n * 5) % 17 == 3 or (i + n) % 41 in (10, 13) or (i + 3 * n) % 101 in (50, 51, 52, 53):
            return None
        return 42.0 if i % 90 > 70 else 100.0 + i % 24 / 4 + n / 8

    data = [(f"D{n}", None if n == 1 else "S", ZERO + timedelta(minutes=10 * i), 41.0 + n / 100, -87.0, value(i, n), 50.0, 20.0)
            for n in range(3) for i in range(240)]
    return spark.createDataFrame(data, "datasourceId string, sourceId string, time timestamp, locationLatitude double, locationLongitude double, "
                                       f"`{PM25_RAW}` double, `{HUMIDITY_RAW}` double, `{TEMPERATURE_RAW}` double")


def broadcast_keys(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]


def test_readings_are_never_broadcast(spark, monkeypatch):
    """Files of compressed readings look small; broadcast, their rows would fill the driver."""
    seen = []
    for module in (cleaners, impute):
        monkeypatch.setattr(module, "cut", lambda df, write=module.cut: (seen.append(broadcast_keys(df)), write(df))[1])
    whole = cleaners.prepare_minute_pm25(minutes(spark))
    seen.append(broadcast_keys(whole))
    parts = cleaners.prepare_minute_pm25(minutes(spark), segment_rows=50)
    seen.append(broadcast_keys(parts))
    assert len(seen) > 4
    assert [line for lines in seen for line in lines if any(k in line for k in OF_READINGS)] == []

    got = rows(parts)
    assert got == rows(whole)
    assert {r["impute_flag"] for r in parts.select("impute_flag").distinct().collect()} == {"impute_5to20"}


def test_a_gap_without_neighbours_stays(spark):
    """Its sensor is in no list; beside it, a row without a key matches nothing."""
    gaps = series(spark, [None, None]).select(F.lit("A").alias("key"), "time", F.monotonically_increasing_id().alias("id"))
    gaps = gaps.unionByName(gaps.withColumn("key", F.lit("lone")).withColumn("id", F.col("id") - 100))
    gaps = gaps.unionByName(gaps.filter("key = 'A'").withColumn("key", F.lit(None).cast("string")).withColumn("id", F.col("id") - 200))
    near = spark.createDataFrame([("A", "B", 1.0, 1)], "key1 string, key2 string, dist_km double, rn bigint")
    known = series(spark, [4.0, 6.0]).withColumn("key", F.lit("B"))
    known = known.unionByName(known.withColumn("key", F.lit(None).cast("string")).withColumn("v", F.lit(9.0)))
    means = impute.neighbor_means(gaps, near, known, "time", "v", ["id"])
    wanted = dict((r["id"], r["time"]) for r in gaps.filter("key = 'A'").collect())
    assert rows(means) == rows(spark.createDataFrame([(i, 4.0 if t == ZERO else 6.0) for i, t in wanted.items()], "id bigint, nb_mean double"))
