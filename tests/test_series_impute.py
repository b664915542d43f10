import random

import pytest
from helpers import SERIES, ZERO, rows, series, values
from datetime import timedelta
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smogline.functions.geo import sensor_key
from smogline.operators import impute, quality
from smogline.operators import series as sr

SIZES = [1000, 9]


def lone_gaps(x, threshold):
    """Row by row, later gaps seeing earlier fillings."""
    x = list(x)
    for i in range(1, len(x) - 1):
        if x[i] is None and x[i - 1] is not None and x[i + 1] is not None:
            middle = (x[i - 1] + x[i + 1]) / 2
            around = [v for v in x[max(0, i - 5):i + 6] if v is not None]
            mean = sum(around) / len(around)
            if mean != 0 and abs(middle - mean) / abs(mean) <= threshold:
                x[i] = middle
    return x


def flat_rows(x):
    out = []
    for i in range(len(x)):
        around = [v for v in x[max(0, i - 5):i + 6] if v is not None]
        out.append(len(around) >= 2 and min(around) == max(around))
    return out


def long_runs(x):
    out, i = [], 0
    while i < len(x):
        j = i
        while j < len(x) and x[j] is None:
            j += 1
        if j > i:
            out.append((i, j - 1, j - i, x[i - 1] if i else None, x[j] if j < len(x) else None))
        i = max(j, i + 1)
    return out


def noisy(n, share, seed, spread=8.0):
    r = random.Random(seed)
    return [None if r.random() < share else round(100 + r.random() * spread, 2) for _ in range(n)]


def same_values(a, b):
    return len(a) == len(b) and all(
        (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9) for x, y in zip(a, b))


def test_rows_are_numbered_across_blocks(spark):
    df = series(spark, [float(i) for i in range(200)], minutes=13).unionByName(
        series(spark, [float(i) for i in range(7)], "D2"))
    placed = sr.place_rows(df, "time", segment_rows=20)
    assert placed.split
    got = placed.df.filter("datasourceId = 'D1'").select("v", "_pos", "_seg").collect()
    assert len(got) == 200 and all(r["_pos"] == int(r["v"]) and r["_seg"] == r["_pos"] // 20 for r in got)


def test_flatline_golden(spark):
    df = series(spark, [1.0] + [5.0] * 11 + [9.0])
    left = sr.drop_flatline(df, "time", "v")
    assert left.count() == 12
    assert df.exceptAll(left).first()["time"] == ZERO + timedelta(minutes=60)
    assert sr.drop_flatline(series(spark, [5.0, 5.0]), "time", "v").count() == 0
    assert sr.drop_flatline(series(spark, [5.0]), "time", "v").count() == 1
    assert sr.drop_flatline(series(spark, [5.0, None]), "time", "v").count() == 2


@pytest.mark.parametrize("size", SIZES)
def test_flatline_brute_force(spark, size):
    r = random.Random(3)
    x = []
    while len(x) < 300:
        x += [r.choice([1.0, 2.0, None])] * r.randint(1, 16)
    left = sr.drop_flatline(series(spark, x), "time", "v", segment_rows=size)
    assert values(left) == [v for v, flat in zip(x, flat_rows(x)) if not flat]


@pytest.mark.parametrize("size", SIZES)
def test_rolling_deviation_does_not_see_segments(spark, size):
    x = noisy(150, 0.2, 4)
    whole = sr.rolling_sd(sr.place_rows(series(spark, x), "time"), "v").df
    cut = sr.rolling_sd(sr.place_rows(series(spark, x), "time", segment_rows=size), "v").df
    assert same_values(values(whole, "rolling_sd"), values(cut, "rolling_sd"))


def test_single_gap_golden(spark):
    placed = sr.place_rows(series(spark, [13.0, None, 11.0, 10.0, None, 12.0]), "time")
    assert values(impute.fill_single_gaps(placed, "v").rows()) == [13, 12, 11, 10, None, 12]
    assert values(impute.fill_single_gaps(placed, "v", mode="window").rows()) == [13, 12, 11, 10, 11, 12]
    edges = sr.place_rows(series(spark, [None, 10.0, None, None, 10.0, None]), "time")
    assert values(impute.fill_single_gaps(edges, "v").rows()) == [None, 10, None, None, 10, None]
    with pytest.raises(ValueError):
        impute.fill_single_gaps(placed, "v", mode="guess")


@pytest.mark.parametrize("size", [1000, 7])
@pytest.mark.parametrize("threshold", [0.05, 0.015])
def test_single_gaps_brute_force(spark, size, threshold):
    data = {f"D{i}": noisy(250, 0.3, i) for i in range(2)}
    df = series(spark, data["D0"], "D0").unionByName(series(spark, data["D1"], "D1"))
    got = impute.fill_single_gaps(sr.place_rows(df, "time", segment_rows=size), "v", threshold).rows()
    for name, x in data.items():
        assert same_values(values(got.filter(F.col("datasourceId") == name)), lone_gaps(x, threshold))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(x=st.lists(st.one_of(st.none(), st.sampled_from([9.0, 10.0, 10.5, 11.0, 0.0])), min_size=1, max_size=60))
def test_single_gaps_any_series(spark, x):
    got = impute.fill_single_gaps(sr.place_rows(series(spark, x), "time", segment_rows=8), "v").rows()
    assert same_values(values(got), lone_gaps(x, 0.05))


def test_column_names_with_dots(spark):
    df = series(spark, [13.0, None, 11.0, 10.0, None, 12.0]).withColumnRenamed("v", "v.raw")
    got = impute.fill_single_gaps(sr.place_rows(df, "time"), "v.raw").rows()
    assert got.columns == df.columns
    assert [r["v.raw"] for r in got.orderBy("time").collect()] == [13, 12, 11, 10, None, 12]


@pytest.mark.parametrize("size", SIZES)
def test_null_runs_brute_force(spark, size):
    x = noisy(200, 0.55, 8)
    x[30:90] = [None] * 60  # longer than several segments
    runs = sr.null_runs(sr.place_rows(series(spark, x), "time", segment_rows=size), "v")
    got = sorted(tuple(r) for r in runs.select("start", "stop", "length", "edge_before", "edge_after").collect())
    assert got == long_runs(x)


NEAR = "key1 string, key2 string, dist_km double, rn long"


def chunk_case(spark, own, near, size=1000):
    """Fill ``own`` (sensor D1) from a neighbour that reports ``near``."""
    df = series(spark, own).unionByName(series(spark, near, "D2"))
    links = spark.createDataFrame([("D1||S1", "D2||S1", 1.0, 1)], NEAR)
    placed = sr.place_rows(df, "time", segment_rows=size)
    return values(impute.fill_gap_chunks(placed, links, "v").rows().filter("datasourceId = 'D1'"))


@pytest.mark.parametrize("size", [1000, 2])
def test_gap_chunks_golden(spark, size):
    assert chunk_case(spark, [10.0, None, None, 10.0], [1.0, 10.2, 10.0, 1.0], size) == [10, 10.2, 10.0, 10]
    assert chunk_case(spark, [12.0, None, None, 10.0], [1.0, 10.2, 10.0, 1.0], size) == [12, None, None, 10]
    assert chunk_case(spark, [None, None, 10.0], [10.2, 10.0, 1.0], size) == [10.2, 10.0, 10]
    assert chunk_case(spark, [10.0, None, None, 10.0], [1.0, 10.2, None, 1.0], size) == [10, 10.2, None, 10]
    assert chunk_case(spark, [10.0, None, 10.0], [10.0, 10.0, 10.0], size) == [10, None, 10]


def network(spark, n, share, seed=1):
    """Three sensors close to each other."""
    df = None
    for i in range(3):
        part = series(spark, noisy(n, share, seed + i, 3.0), f"D{i}").withColumns(
            {"locationLatitude": F.lit(41.0 + i / 100), "locationLongitude": F.lit(-87.0)})
        df = part if df is None else df.unionByName(part)
    return df


@pytest.mark.parametrize("nulls,kept,flag", [(4, 96, "drop_na_lt5"), (5, 100, "impute_5to20"),
                                             (19, 100, "impute_5to20"), (20, 100, "no_impute_ge20")])
def test_branches(spark, nulls, kept, flag):
    x = [10.0] * 100
    for i in range(nulls):
        x[5 * i + 2] = None
    df = series(spark, x).withColumns({"locationLatitude": F.lit(41.0), "locationLongitude": F.lit(-87.0)})
    out = impute.qa_qc_impute(df, "time", "v")
    assert rows(quality.flag_counts(out)) == [(flag, kept)]


def test_imputation_does_not_see_segments(spark):
    df = network(spark, 120, 0.13)
    plain = impute.qa_qc_impute(df, "time", "v")
    cut = impute.qa_qc_impute(df, "time", "v", segment_rows=11)
    a, b = (sorted((r.datasourceId, r.time, r.v is None, round(r.v or 0, 9)) for r in d.collect()) for d in (plain, cut))
    assert a == b and len(a) == 360
    assert sum(r[2] for r in a) < df.filter("v is null").count()


def test_rows_without_time_come_last(spark):
    df = spark.createDataFrame([("D", "S", None, 1.0), ("D", "S", ZERO, 2.0)], SERIES)
    for size in (1000, 1):
        got = sr.place_rows(df, "time", segment_rows=size).df
        assert rows(got, "v", "_pos") == [(1.0, 1), (2.0, 0)]


def test_one_sort_serves_all_windows(spark):
    df = sr.drop_flatline(series(spark, [1.0] * 30), "time", "v")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("size", [1000, 9])
def test_equal_times_lose_no_rows(spark, size):
    x = noisy(120, 0.3, 6)
    df = series(spark, x).withColumn("time", F.date_trunc("hour", "time"))
    filled = impute.fill_single_gaps(sr.place_rows(df, "time", segment_rows=size), "v").rows()
    assert filled.count() == 120 and rows(filled.groupBy("time").count()) == rows(df.groupBy("time").count())


def timeless(spark, n=60):
    """Readings of which a third have no time, many of them alike but for the ``tie`` column."""
    r = random.Random(21)
    data = [("D", None if i % 3 else "S", None if i % 3 == 0 else f"2026-01-01T00:{r.randint(0, 59):02d}:00Z", float(r.randint(1, 5)) if i % 7 else None, i)
            for i in range(n)]
    df = spark.createDataFrame(data, "datasourceId string, sourceId string, t string, v double, tie int")
    return df.withColumn("time", F.to_timestamp("t")).drop("t")


@pytest.mark.parametrize("tie", [(), ("tie",)])
def test_one_row_order_at_every_size(spark, tie):
    """Rows without a time, and ties, have the same place whether series are split or not."""
    df = timeless(spark)
    columns = [F.col(c) for c in tie]

    def places(size):
        placed = sr.place_rows(df, "time", tie=columns, segment_rows=size)
        assert placed.split == (size < 60)
        return rows(placed.df.select("tie", "sourceId", "_pos"))

    def spread(size):
        return rows(sr.rolling_sd(sr.place_rows(df, "time", tie=columns, segment_rows=size), "v").df.select("tie", F.round("rolling_sd", 9)))

    def filled(size):
        return rows(impute.fill_single_gaps(sr.place_rows(df, "time", tie=columns, segment_rows=size), "v", 0.5).rows().select("tie", "v"))

    def runs(size):
        return rows(sr.null_runs(sr.place_rows(df, "time", tie=columns, segment_rows=size), "v").select("sourceId", "start", "stop"))

    def flat(size):
        return rows(sr.drop_flatline(df, "time", "v", 1, 1, tie=columns, segment_rows=size).select("tie"))

    for result in (places, spread, filled, runs, flat):
        assert result(1000) == result(12) == result(7), result.__name__


def test_a_missing_source_is_filled_like_any_other(spark):
    """A run of two nulls is filled from the neighbours, also for the sensor without a source."""
    data = [("A", s, i, None if i in (4, 5) and s != "n" else 10.0) for s in ("S", None, "n") for i in range(10)]
    df = spark.createDataFrame(data, "datasourceId string, sourceId string, i int, v double").withColumn(
        "time", F.lit("2026-01-01").cast("timestamp") + F.make_interval(hours=F.col("i")))
    keys = ["A||S", "A||", "A||n"]
    placed = sr.place_rows(df, "time")
    key = df.select(sensor_key()).distinct().collect()
    keys = [r[0] for r in key]
    pairs = spark.createDataFrame([(a, b, 1.0, n + 1) for a in keys for n, b in enumerate(k for k in keys if k != a)],
                                  "key1 string, key2 string, dist_km double, rn long")
    got = impute.fill_gap_chunks(placed, pairs, "v").rows()
    assert got.count() == 30 and got.filter("v is null").count() == 0


def test_gap_tables_composed_by_doubling():
    import numpy as np

    tables = np.random.default_rng(3).integers(0, 16, 300)
    states, want = [0, 1, 2, 3], []
    for bits in tables:
        states = [((int(bits) >> s) & 1) + 2 * (s & 1) for s in states]
        want.append(states)
    assert impute._chain(impute._maps(tables)).tolist() == want


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_the_long_grid_is_imputed(spark, folder):
    """The grid that the benchmark times has lone gaps and runs, and takes the imputing branch."""
    from checks import tables

    grid = tables.long_grid(spark, folder)
    share = quality.missing_rate(grid, "value").first()[0]
    assert 0.05 <= share < 0.2
    assert [r[0] for r in impute.qa_qc_impute(grid, "time", "value").select("impute_flag").distinct().collect()] == ["impute_5to20"]
