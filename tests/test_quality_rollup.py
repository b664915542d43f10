import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from smogline.operators import quality, rollup
from smogline.plans import cleaners
from smogline.schema import METRICS, MetricSpec

NAN = float("nan")
READINGS = "datasourceId string, sourceId string, ts timestamp, v double"


def readings(spark, *pairs):
    return spark.createDataFrame([("D", "S", at(t), x) for t, x in pairs], READINGS)


def test_hours_ignore_missing(spark):
    df = readings(spark, ("2026-01-01 00:10", 1.0), ("2026-01-01 00:40", 3.0),
                  ("2026-01-01 01:00", None), ("2026-01-01 01:30", NAN))
    from smogline.functions.values import nan_to_null

    df = df.withColumn("v", nan_to_null("v"))
    hours = rollup.rollup_hour(df, "ts", "v")
    assert rows(hours, F.hour("hour"), "n_valid", "metric", "is_valid") == [(0, 2, 2.0, True), (1, 0, None, False)]
    assert rollup.rollup_all(df, "ts", "v", 3).count() == 0


def test_midnight_belongs_to_the_next_day(spark):
    hours = rollup.rollup_hour(readings(spark, ("2026-01-02 00:00", 1.0)), "ts", "v")
    assert rows(rollup.label_days(rollup.rollup_day(hours)), "date") == [("2026-01-02",)]


@pytest.mark.parametrize("n,valid", [(20, False), (21, True)])
def test_day_needs_more_than_twenty_hours(spark, n, valid):
    hours = rollup.rollup_hour(readings(spark, *[(f"2026-01-01 {h:02d}:30", 1.0) for h in range(n)]), "ts", "v")
    assert rows(rollup.rollup_day(hours), "n_valid", "is_valid") == [(n, valid)]


def test_day_is_the_mean_of_hourly_means(spark):
    df = readings(spark, ("2026-01-01 00:10", 1.0), ("2026-01-01 00:20", 1.0), ("2026-01-01 00:30", 1.0),
                  ("2026-01-01 01:10", 4.0))
    assert rows(rollup.rollup_day(rollup.rollup_hour(df, "ts", "v"), 1), "metric") == [(2.5,)]


def test_levels_above_days(spark):
    days = spark.sql("""SELECT 'D' datasourceId, 'S' sourceId, explode(sequence(timestamp'2025-01-01',
        timestamp'2025-12-31', interval 1 day)) day, 2.0D metric, true is_valid""")
    levels = rollup.rollup_days(days, {"week": 5, "month": 21, "season": 60, "year": 250})
    valid = {r[0]: r[1] for r in levels.filter("is_valid").groupBy("type").count().collect()}
    # The last days of December are in week 1 of 2026, January 1-5 in a week of five days.
    assert valid == {"week": 51, "month": 12, "season": 3, "year": 1}
    assert ("2026-winter", 31, False) in rows(levels.filter("type = 'season'"), "date", "n_valid", "is_valid")


def test_completeness(spark):
    hours = spark.createDataFrame([("D", "S", x) for x in (True, True, True, False)],
                                  "datasourceId string, sourceId string, is_valid boolean")
    assert rows(quality.completeness(hours), "hours_total", "hours_valid", "pct_valid") == [(4, 3, 75.0)]


def test_day_holds_at_most_24_hours(spark, folder):
    from checks import tables

    levels = rollup.rollup_all(tables.hourly(spark, folder), "endOfPeriod", "value")
    assert levels.filter("type = 'day' and n_valid > 24").count() == 0


@pytest.mark.parametrize("qc,kept", [(True, 3), ("true", 3), (False, 4), ("yes", 4)])
def test_invalid_rows(spark, qc, kept):
    df = spark.createDataFrame([("valid",), ("invalid",), (None,), ("suspect",)], "`x.qcAssessment` string")
    assert quality.drop_invalid_qc(df, MetricSpec("m", "x.value", qc=qc)).count() == kept


def test_ranges_are_closed_and_keep_nulls(spark):
    df = spark.createDataFrame([(x,) for x in (-0.1, 0.0, 500.0, 500.1, None)], "`p.raw` double")
    assert rows(quality.filter_ranges(df, {"p.raw": (0, 500)})) == [(0.0,), (500.0,), (None,)]


def test_metric_selection(spark):
    df = spark.createDataFrame([], "datasourceId string, `pm2_5Conc.value` double, `pm2_5Conc.qcAssessment` string, "
                                   "`pm2_5NowcastUsEpaAqi.value` double, `no2Conc.value` double, `relHumidInternal.raw` double")
    groups = {"pm25": ["pm2_5*"], "no2": ["no2*"], "internal": ["*Internal*"]}

    def chosen(pattern):
        return quality.select_metrics(df, pattern, groups).columns

    assert chosen(None) == df.columns
    assert chosen("only :no2") == ["datasourceId", "no2Conc.value"]
    assert chosen("only *nowcast*") == ["datasourceId", "pm2_5NowcastUsEpaAqi.value"]
    assert "relHumidInternal.raw" in chosen("only :pm25 + :internal") and "no2Conc.value" not in chosen("only :pm25 + :internal")
    with pytest.raises(ValueError):
        chosen("only :radon")


def test_renames(spark):
    df = spark.createDataFrame([], "endOfPeriod string, n_obs int")
    assert quality.rename_columns(df, {"endOfPeriod": "date", "week": "date"}).columns == ["date", "n_obs"]
    with pytest.raises(ValueError):
        quality.rename_columns(df, {"endOfPeriod": "date", "n_obs": "date"})
    for spec in METRICS.values():
        assert quality.rename_columns(df, spec.rename_columns).columns


def test_time_filter_reaches_the_scan(spark, folder):
    from datetime import datetime

    df = quality.filter_time(spark.read.parquet(f"{folder}/orders.parquet"), "o_orderdate",
                             datetime(1998, 1, 1), datetime(1998, 2, 1)).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "o_totalprice" not in plan


def test_rollups_share_their_shuffles(spark, folder):
    from checks import tables

    df = rollup.rollup_all(tables.hourly(spark, folder), "endOfPeriod", "value")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2
    assert plan.count("FileScan") == 1


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("D", "S", 1.0), ("D", "S", nan), ("D", "S", 3.0), ("D", "S", None)],
                               "datasourceId string, sourceId string, v double").withColumn("t", F.lit("2026-01-01").cast("timestamp"))
    hour = rollup.rollup_hour(df, "t", "v").first()
    assert (hour["n_valid"], hour["metric"], hour["is_valid"]) == (2, 2.0, True)
    assert quality.filter_ranges(df, {"v": (2.0, 4.0)}).count() == 3
    spec = MetricSpec("m", "v")
    cleaned = cleaners.clean(df.withColumnRenamed("t", "endOfPeriod"), spec).filter("type = 'hour'").first()
    assert (cleaned["m"], cleaned["n_valid"]) == (2.0, 2)
