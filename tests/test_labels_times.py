from datetime import datetime

import pytest
from helpers import at
from pyspark.sql import functions as F

from smogline.functions import geo, labels, times
from smogline.functions import values as v

GOLDEN = [
    ("2026-01-01 00:00", "2026-01-01", "2026-W01", "2026-01", "2026-winter", "2026"),
    ("2026-02-05 13:00", "2026-02-05 13:00:00", "2026-W06", "2026-02", "2026-winter", "2026"),
    ("2024-12-30 23:00", "2024-12-30 23:00:00", "2025-W01", "2024-12", "2025-winter", "2024"),
    ("2021-01-03 05:00", "2021-01-03 05:00:00", "2020-W53", "2021-01", "2021-winter", "2021"),
    ("2025-03-01 00:00", "2025-03-01", "2025-W09", "2025-03", "2025-spring", "2025"),
    ("2025-11-30 12:00", "2025-11-30 12:00:00", "2025-W48", "2025-11", "2025-autumn", "2025"),
]


def test_labels(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "t string").withColumn("ts", F.to_timestamp("t"))
    got = df.select("t", labels.hour_label("ts"), *[labels.LABELS[x]("ts") for x in ("week", "month", "season", "year")])
    assert sorted(tuple(r) for r in got.collect()) == sorted(GOLDEN)


def test_type_rank(spark):
    df = spark.createDataFrame([("year",), ("hour",), ("week",), ("decade",)], "type string")
    assert {r[0]: r[1] for r in df.select("type", labels.type_rank()).collect()} == {
        "year": 0, "hour": 5, "week": 3, "decade": None}


NOW = at("2026-02-06 13:45")
BOUNDS = [
    ("3hours", "current", "2026-02-06 10:00", "2026-02-06 13:00"),
    ("3hours", "previous", "2026-02-06 07:00", "2026-02-06 10:00"),
    ("day", "previous", "2026-02-05", "2026-02-06"), ("day", "current", "2026-02-06", "2026-02-07"),
    ("week", "previous", "2026-01-26", "2026-02-02"), ("week", "current", "2026-02-02", "2026-02-09"),
    ("month", "previous", "2026-01-01", "2026-02-01"), ("month", "current", "2026-02-01", "2026-03-01"),
    ("season", "previous", "2025-09-01", "2025-12-01"), ("season", "current", "2025-12-01", "2026-03-01"),
    ("year", "previous", "2025-01-01", "2026-01-01"), ("year", "current", "2026-01-01", "2027-01-01"),
]


@pytest.mark.parametrize("kind,which,start,end", BOUNDS)
def test_period_bounds(kind, which, start, end):
    assert times.period_bounds(kind, which, NOW) == (at(start), at(end))


def test_period_bounds_in_december():
    now = datetime(2025, 12, 15)
    assert times.season_bounds(now) == (at("2025-12-01"), at("2026-03-01"))
    assert times.period_bounds("season", "previous", now) == (at("2025-09-01"), at("2025-12-01"))


def test_period_bounds_refuses_unknown():
    with pytest.raises(ValueError):
        times.period_bounds("decade", "current", NOW)
    with pytest.raises(ValueError):
        times.period_bounds("day", "next", NOW)


def test_run_windows():
    window = times.run_window
    assert window(NOW) == (at("2026-02-06 10:00"), None)
    assert window(NOW, start=at("2026-02-01")) == (at("2026-02-01"), None)
    assert window(NOW, historical=True) == (at("2026-01-01"), at("2026-02-01"))
    assert window(NOW, True, start=at("2025-05-01")) == (at("2025-05-01"), at("2026-02-01"))
    assert window(NOW, True, end=at("2026-01-10")) == (at("2026-01-01"), at("2026-01-10"))
    assert window(NOW, True, ["hour"]) == (at("2026-02-06 10:00"), at("2026-02-06 13:00"))
    assert window(NOW, True, ["season", "day", "week"]) == (at("2025-09-01"), at("2025-12-01"))
    assert window(NOW, True, ["year", "hour"]) == (at("2025-01-01"), at("2026-01-01"))
    for bad in ({"levels": ["decade"], "historical": True}, {"levels": ["day"]}, {"historical": True, "levels": ["day"], "start": NOW}):
        with pytest.raises(ValueError):
            window(NOW, **bad)


@pytest.mark.parametrize("kind", ["day", "week", "month", "season", "year"])
def test_period_start_columns_agree_with_bounds(spark, kind):
    moments = [NOW, datetime(2025, 12, 15), datetime(2024, 2, 29, 23, 59), datetime(2024, 3, 1)]
    df = spark.createDataFrame([(m,) for m in moments], "ts timestamp")
    got = {r[0]: r[1:] for r in df.select(
        "ts", *[times.period_start(kind, "ts", n) for n in (-1, 0, 1)]).collect()}
    for m in moments:
        before, start = times.period_bounds(kind, "previous", m)
        assert got[m] == (before, start, times.period_bounds(kind, "current", m)[1])


def test_time_text(spark):
    df = spark.createDataFrame([("2026-01-01T05:06:07.890Z",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(times.format_iso(times.parse_time("t"))).collect()]
    assert got == ["2026-01-01T05:06:07.000Z", None, None]


def test_calibration_and_distance(spark):
    df = spark.createDataFrame([(100.0, 50.0), (343.0, 50.0), (100.0, None), (400.0, None), (None, 1.0)],
                               "raw double, rh double")
    got = [r[0] for r in df.select(v.calibrate_pm25("raw", "rh")).collect()]
    assert got[0] == pytest.approx(53.84) and got[1] == pytest.approx(206.986057)
    assert got[2] is None and got[3] is not None and got[4] is None
    one = spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert one == pytest.approx(111.19492664455873, abs=1e-9)


def test_rounding_masking_keys(spark):
    df = spark.createDataFrame([(0.03125, "a" * 21, "b" * 20)], "x double, long string, short string")
    got = df.select(geo.round_coord("x"), v.mask_text("long"), v.mask_text("short"),
                    geo.sensor_key(["long", "short"])).first()
    assert got[0] == 0.0312 and got[1] == "a" * 20 + "..." and got[2] == "b" * 20
    assert got[3] == "a" * 21 + "||" + "b" * 20
    assert v.qc_column_for("x.value") == "x.qcAssessment"


def test_geocode_text(spark):
    df = spark.createDataFrame([(41.5, -87.6), (0.0005, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(geo.geocode("a", "b")).collect()] == ["41.5, -87.6", "0.0005, 0.0", None]


def test_relative_difference(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0), (3.0, -2.0)], "a double, b double")
    assert [r[0] for r in df.select(v.rel_diff("a", "b")).collect()] == [0.5, None, None, 2.5]


def test_coordinates_round_as_numpy_does(spark):
    import numpy as np

    x = [i / 3200 - 88 for i in range(2000)] + [41.87125, 0.09375, -0.03125]
    got = [r[0] for r in spark.createDataFrame([(v_,) for v_ in x], "x double").select(geo.round_coord("x")).collect()]
    assert got == list(np.round(x, 4))
