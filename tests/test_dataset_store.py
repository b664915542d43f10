from datetime import datetime

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from smogline.operators import dataset
from pyspark.sql import functions as F

from smogline.plans import metric_run, store
from smogline.schema import CELLS, LOCATIONS, METRICS
from smogline.sources import measurements, sinks, versions

PERIODS = "type string, date string, datasourceId string, sourceId string, metric double"


def cells(spark, *data):
    return spark.createDataFrame(list(data), CELLS)


def test_upsert_order_and_offsets(spark):
    old = cells(spark, ("hour", "2026-01-01", "A", 1.0), ("hour", "2026-01-01", "B", 2.0))
    new = cells(spark, ("hour", "2026-01-01", "A", 9.0), ("hour", "2026-01-01", "B", None),
                ("hour", "2026-01-01", "C", 3.0), ("day", "2026-01-01", "A", 4.0))
    merged = dataset.upsert_measurements(old, new)
    matrix = dataset.order_latest_first(dataset.pivot_cells(merged))
    assert [tuple(r) for r in matrix.select("type", "date", "A", "B", "C").collect()] == [
        ("hour", "2026-01-01", 9.0, 2.0, 3.0), ("day", "2026-01-01", 4.0, None, None)]
    offsets = {r[0]: r[1] for r in dataset.type_offsets(matrix).collect()}
    assert offsets == {"hour": 0, "day": 1, "week": 0, "month": 0, "season": 0, "year": 0}
    assert rows(dataset.upsert_measurements(merged, new)) == rows(merged)


_cell = st.tuples(st.sampled_from(["hour", "day"]), st.sampled_from(["2026-01-01", "2026-01-02"]),
                  st.sampled_from(["A", "B"]))
_side = st.dictionaries(_cell, st.one_of(st.none(), st.integers(0, 9).map(float)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=_side, b=_side)
def test_upsert_properties(spark, a, b):
    def frame(side):
        return cells(spark, *[(*k, v) for k, v in side.items()])

    merged = dataset.upsert_measurements(frame(a), frame(b))
    expected = {k: b.get(k) if b.get(k) is not None else a.get(k) for k in {**a, **b}}
    assert {tuple(r)[:3]: r["value"] for r in merged.collect()} == expected
    assert rows(dataset.upsert_measurements(merged, frame(b))) == rows(merged)
    assert rows(dataset.upsert_measurements(frame(a), frame({}))) == rows(frame(a).select("type", "date", "datasourceId", "value"))


def test_pivot_takes_the_greatest_source_with_a_value(spark):
    df = spark.createDataFrame([("day", "d1", "A", "s1", 1.0), ("day", "d1", "A", "s2", 2.0), ("day", "d1", "A", "s3", None),
                                ("day", "d2", "B", "s1", None)], PERIODS)
    matrix = dataset.pivot_sensors(df)
    assert matrix.columns == ["type", "date", "A"]
    assert rows(matrix) == [("day", "d1", 2.0)]
    assert rows(dataset.unpivot_sensors(matrix)) == [("day", "d1", "A", 2.0)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    b = spark.createDataFrame([(1, 3)], "a int, c int")
    both = dataset.combine_rows(a, b)
    assert rows(both) == [(1, 2, None), (1, None, 3)]
    assert rows(dataset.combine_rows(both, both)) == rows(both)


def test_locations_upsert(spark):
    old = spark.createDataFrame([("D1", "S1", 1.0, "60601")], "datasourceId string, sourceId string, lat double, zip string")
    new = spark.createDataFrame([("D2", "S2", 3.0), ("D1", "S1", 2.0)], "datasourceId string, sourceId string, lat double")
    got = dataset.upsert_locations(old, new)
    assert [tuple(r) for r in got.select("datasourceId", "sourceId", "lat", "zip").collect()] == [
        ("D1", "S1", 2.0, "60601"), ("D2", "S2", 3.0, None)]


def test_merging_locations_with_themselves(spark):
    table = spark.createDataFrame([("D1", None, 1.0), (None, None, 2.0), ("D1", "S", 3.0)], "datasourceId string, sourceId string, lat double")
    assert rows(dataset.upsert_locations(table, table)) == rows(table)


def test_first_dataset_is_empty(spark, shared):
    df = measurements.read_dataset_or_empty(spark, shared("none"), LOCATIONS)
    assert df.count() == 0 and df.schema == LOCATIONS


def test_dataset_layout(spark, shared):
    path = shared("layout")
    df = cells(spark, *[("hour", f"2026-01-{d:02d} 0{h}:00:00", "A", 1.0) for d in range(1, 9) for h in range(1, 5)],
               ("day", "2026-01-01", "A", 1.0))
    sinks.write_dataset(df, path)
    back = spark.read.parquet(path)
    assert rows(back.select(*df.columns)) == rows(df)
    plan = dataset.filter_type(back, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan


TYPES = {"hour": "2026-{:02d}-03 {:02d}:00:00", "day": "2026-{:02d}-{:02d}", "week": "2026-W{:02d}{:02d}", "month": "20{1:02d}-{0:02d}",
         "season": "20{1:02d}-{0:02d}", "year": "2{1:03d}"}


def newest_first(spark, path):
    """Every file's dates, as stored."""
    import glob

    import pyarrow.parquet as pq

    files = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]
    assert files
    for f in files:
        dates = pq.ParquetFile(f).read(columns=["date"]).column("date").to_pylist()
        assert dates == sorted(dates, reverse=True), f
    return files


def test_files_hold_the_newest_first(spark, shared):
    data = [(t, form.format(m, n), ds, 1.0) for t, form in TYPES.items() for m in (1, 2, 3) for n in range(10, 20) for ds in "AB"]
    dataset_path, path = shared("dataset"), shared("store")
    df = cells(spark, *sorted(set(data), key=hash)).repartition(4)
    sinks.write_dataset(df, dataset_path)
    assert len({f.split("type=")[1].split("/")[0] for f in newest_first(spark, dataset_path)}) == 6
    store.merge_into_store(spark, df, path)
    store.merge_into_store(spark, df.filter("date like '2026-02%'").withColumn("value", F.lit(2.0)), path)
    folders = {f.rsplit("/version=", 1)[0] for f in newest_first(spark, path)}
    assert len(folders) > 12 and len({f.split("type=")[1].split("/")[0] for f in folders}) == 6


def test_store_rewrites_touched_partitions_only(spark, shared):
    import glob

    path = shared("store")
    store.merge_into_store(spark, cells(spark, ("hour", "2026-01-01", "A", 1.0), ("hour", "2026-02-01", "A", 1.0)), path)
    untouched = set(glob.glob(f"{path}/type=hour/bucket=2026-01-01/*/*.parquet"))
    assert untouched
    store.merge_into_store(spark, cells(spark, ("hour", "2026-02-01", "A", 5.0), ("year", "2026", "A", 3.0)), path)
    assert set(glob.glob(f"{path}/type=hour/bucket=2026-01-01/*/*.parquet")) == untouched
    assert rows(store.read_store(spark, path), "date", "value") == [("2026", 3.0), ("2026-01-01", 1.0), ("2026-02-01", 5.0)]


def test_readers_see_old_or_new(spark, shared):
    """A frame made before a change still gives the old rows after it."""
    path = shared("store")
    store.merge_into_store(spark, cells(spark, ("day", "2026-01-01", "A", 1.0)), path)
    before = store.read_store(spark, path)
    store.merge_into_store(spark, cells(spark, ("day", "2026-01-01", "A", 2.0), ("day", "2026-02-01", "A", 2.0)), path)
    assert rows(before, "date", "value") == [("2026-01-01", 1.0)]
    assert rows(store.read_store(spark, path), "date", "value") == [("2026-01-01", 2.0), ("2026-02-01", 2.0)]


def test_interrupted_change_has_changed_nothing(spark, shared, monkeypatch):
    import glob

    path = shared("store")
    store.merge_into_store(spark, cells(spark, ("hour", "2026-01-01", "A", 1.0), ("hour", "2026-01-01", "C", 4.0)), path)

    def stopped(*_):
        raise KeyboardInterrupt

    new = cells(spark, ("hour", "2026-01-01", "A", 2.0), ("hour", "2026-01-01", "B", 3.0))
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", stopped)
        with pytest.raises(KeyboardInterrupt):
            store.merge_into_store(spark, new, path)
    assert rows(store.read_store(spark, path), "datasourceId", "value") == [("A", 1.0), ("C", 4.0)]
    assert len(glob.glob(f"{path}/type=hour/bucket=2026-01-01/version=*")) == 2
    store.merge_into_store(spark, new, path)
    store.merge_into_store(spark, new, path)
    assert rows(store.read_store(spark, path), "datasourceId", "value") == [("A", 2.0), ("B", 3.0), ("C", 4.0)]
    assert len(glob.glob(f"{path}/type=hour/bucket=2026-01-01/version=*")) == 2  # the last two; the rest is gone


def test_a_second_writer_fails(spark, shared, monkeypatch):
    path = shared("store")
    store.merge_into_store(spark, cells(spark, ("day", "2026-01-01", "A", 1.0)), path)
    monkeypatch.setattr(versions, "_numbers", lambda *_: [])
    with pytest.raises(FileExistsError):
        store.merge_into_store(spark, cells(spark, ("day", "2026-01-01", "A", 2.0)), path)


def test_offsets_from_partition_counts(spark, shared):
    path = shared("store")
    store.merge_into_store(spark, cells(spark, *[("hour", f"2026-0{m}-01 0{h}:00:00", ds, 1.0) for m in (1, 2) for h in (1, 2) for ds in "AB"],
                                        ("day", "2026-01-01", "A", 1.0), ("year", "2026", "A", 1.0)), path)
    matrix = dataset.pivot_cells(store.read_store(spark, path))
    assert rows(store.store_offsets(spark, path)) == rows(dataset.type_offsets(matrix))


def test_replaced_cells_disappear(spark, shared):
    path = shared("store")
    store.merge_into_store(spark, cells(spark, ("day", "2026-01-01", "A", 1.0), ("day", "2026-01-02", "A", 1.0)), path)
    store.merge_into_store(spark, cells(spark), path,
                           replace=cells(spark, ("day", "2026-01-01", "A", None)).drop("value"))
    assert rows(store.read_store(spark, path), "date") == [("2026-01-02",)]


def test_requested_metrics(caplog):
    assert [m.name for m in metric_run.requested_metrics()] == ["nowcast_aqi", "hourly_pm25", "hourly_no2"]
    assert metric_run.requested_metrics("*") == metric_run.requested_metrics(None)
    assert metric_run.requested_metrics(["mean_pm25", "radon"]) == [METRICS["mean_pm25"]]
    assert "radon" in caplog.text


def test_run_metrics_end_to_end(spark, shared, folder):
    from checks import tables
    rows_in = tables.wide(spark, folder).withColumn("sourceId", F.upper("datasourceId"))
    rows_in = rows_in.withColumn("pm2_5ConcMassNowcastUsEpaAqi.qcAssessment", F.col(f"`{tables.ASSESSMENT}`"))
    root = shared("root")
    stored = metric_run.run_metrics(spark, lambda spec: rows_in, root, ["nowcast_aqi", "hourly_no2", "radon"])
    assert set(stored) == {"nowcast_aqi", "hourly_no2"}
    counts = {r[0]: r[1] for r in stored["nowcast_aqi"].groupBy("type").count().collect()}
    assert counts["hour"] > 2000 and counts["day"] > 100
    assert stored["nowcast_aqi"].filter("datasourceId = 'error'").count() == 0
    matrix = metric_run.measurement_matrix(spark, f"{root}/hourly_no2")
    assert matrix.columns == ["type", "date", "click", "purchase", "signup", "view"]
    offsets = {r["type"]: r["first_row"] for r in spark.read.json(f"{root}/hourly_no2.index.json").collect()}
    assert offsets["hour"] == 0 and offsets["day"] == matrix.filter("type = 'hour'").count()


def test_refresh_drops_a_period_that_became_invalid(spark, shared):
    """Hours of one day arrive in two halves; a third run changes one hour of another day."""
    from smogline.schema import MetricSpec

    spec = MetricSpec("m", "x.value")

    def hours(day, first, last, value):
        return spark.range(first, last).select(
            F.lit("D").alias("datasourceId"), F.lit("S").alias("sourceId"), F.lit(value).alias("x.value"),
            (F.to_timestamp(F.lit(day)) + F.make_interval(hours=F.col("id").cast("int"))).alias("endOfPeriod"))

    path = shared("store")
    for part in ((0, 12), (12, 24)):
        metric_run.run_metric(spark, spec, hours("2026-01-05", *part, 2.0), path, refresh=True)
    assert rows(store.read_store(spark, path).filter("type = 'day'"), "date", "value") == [("2026-01-05", 2.0)]
    metric_run.run_metric(spark, spec, hours("2026-01-05", 0, 12, 4.0), path, refresh=True)
    assert rows(store.read_store(spark, path).filter("type = 'day'"), "date", "value") == [("2026-01-05", 3.0)]
    touched = metric_run.touched_periods(cells(spark, ("hour", "2026-01-05 03:00:00", "D", 1.0)))
    assert rows(touched, "type", "date") == [("day", "2026-01-05"), ("month", "2026-01"), ("season", "2026-winter"),
                                             ("week", "2026-W02"), ("year", "2026")]
    metric_run.refresh_periods(spark, path, cells(spark, ("hour", "2026-01-05 03:00:00", "D", 1.0)), {"day": 24})
    assert store.read_store(spark, path).filter("type = 'day'").count() == 0


def test_refresh_never_mixes_sources(spark, shared):
    """One source with 24 hours of 1.0, a greater one with 12 of 3.0: only the first has a valid day."""
    from smogline.schema import MetricSpec

    spec = MetricSpec("m", "x.value")

    def hours(source, n, value):
        return spark.range(n).select(
            F.lit("D").alias("datasourceId"), F.lit(source).alias("sourceId"), F.lit(value).alias("x.value"),
            (F.lit("2026-01-05").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("endOfPeriod"))

    whole = hours("A", 24, 1.0).union(hours("B", 12, 3.0)).union(hours(None, 3, 5.0))
    plain, refreshed, split = shared("plain"), shared("refreshed"), shared("split")
    metric_run.run_metric(spark, spec, whole, plain, count_rows=True)
    metric_run.run_metric(spark, spec, whole, refreshed, refresh=True)
    for part in (hours("B", 12, 3.0), hours(None, 3, 5.0), hours("A", 24, 1.0)):
        metric_run.run_metric(spark, spec, part, split, refresh=True)
    found = rows(store.read_store(spark, plain))
    assert [r for r in found if r[0] == "day"] == [("day", "2026-01-05", "D", 1.0, "2026-01")]
    assert sorted({r[3] for r in found if r[0] == "hour"}) == [1.0, 3.0, 5.0]
    assert found == rows(store.read_store(spark, refreshed)) == rows(store.read_store(spark, split))


def test_a_run_leaves_no_scratch(spark, shared, folder):
    import glob

    from checks import tables
    from smogline.schema import MetricSpec
    from smogline.session import shared_dir

    before = set(glob.glob(f"{shared_dir(spark)}/cut-*"))
    metric_run.run_metric(spark, MetricSpec("m", tables.VALUE), tables.wide(spark, folder), shared("store"), refresh=True)
    assert set(glob.glob(f"{shared_dir(spark)}/cut-*")) == before


def test_locations_are_kept_and_merged(spark, shared, folder):
    """A run renews the table, a second one changes nothing, a supplied file adds to it."""
    from checks import tables
    from smogline.plans import locations
    from smogline.sources.boundaries import flatten_datasources

    path, root, supplied = shared("locations"), shared("root"), shared("supplied")
    given = {"path": path, "datasources": flatten_datasources(tables.datasources(spark, folder)),
             "boundaries": {"wards": tables.regions(spark, folder)}, "order_cols": ["event_id"]}
    readings = tables.wide(spark, folder)
    metric_run.run_metrics(spark, lambda _: readings, root, ["hourly_no2"], locations=given,
                           window=(datetime(2024, 1, 1), datetime(2024, 1, 8)))
    first = locations.read_locations(spark, path)
    assert first.schema == LOCATIONS and first.count() == 15
    hours = store.read_store(spark, f"{root}/hourly_no2").filter("type = 'hour'").agg(F.min("date"), F.max("date")).first()
    assert hours[0] >= "2024-01-01" and hours[1] < "2024-01-08"
    again = locations.update_locations(spark, measurements=readings.filter("endOfPeriod < timestamp'2024-01-08'"), **given)
    assert rows(again, *LOCATIONS.names[:9]) == rows(first, *LOCATIONS.names[:9])
    spark.createDataFrame([("click", "S0", "New name", None), ("far", None, "Far away", "60601")],
                          "datasourceId string, sourceId string, name string, zip string").write.parquet(supplied)
    for _ in range(2):
        merged = {(r["datasourceId"], r["sourceId"]): r for r in locations.merge_location_file(spark, path, supplied).collect()}
        assert len(merged) == 16 and merged[("click", "S0")]["name"] == "New name" and merged[("far", None)]["zip"] == "60601"
        assert merged[("click", "S0")]["locationLatitude"] is not None


def test_unknown_cleaner(spark):
    from smogline.plans.cleaners import clean
    from smogline.schema import MetricSpec

    with pytest.raises(LookupError):
        clean(spark.range(1), MetricSpec("m", "x.value", cleaner="magic"))


def test_minute_metric_end_to_end(spark, shared):
    """Two days of readings every 15 minutes as text times, ranged, cleaned and stored."""
    readings = spark.sql("""SELECT 'D' datasourceId, 'S' sourceId, 41.0D locationLatitude, -87.0D locationLongitude,
        date_format(timestamp'2026-01-01' + make_interval(0,0,0,0,0,15 * cast(id as int),0), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") time,
        10.0D + id % 7 `pm2_5ConcMassIndividual.raw`, 50.0D `relHumidInternalIndividual.raw`, 20.0D `temperatureInternalIndividual.raw`,
        if(id % 4 = 0, 'invalid', 'valid') `pm2_5ConcMassIndividual.qcAssessment` FROM range(192)""")
    stored = metric_run.run_metric(spark, METRICS["mean_pm25"], readings, shared("pm"),
                                   start=datetime(2026, 1, 1), end=datetime(2026, 1, 2))
    assert rows(stored.groupBy("type").count()) == [("day", 1), ("hour", 24)]


def test_a_snapshot_of_the_store_is_a_store(spark, shared):
    path, root = shared("store"), shared("snapshots")
    store.merge_into_store(spark, cells(spark, ("hour", "2026-01-01", "A", 1.0), ("hour", "2026-02-01", "A", 2.0)), path)
    copy = sinks.snapshot_dataset(spark, {"pm": path}, root, "2026-02-02") + "/pm"
    assert rows(store.read_store(spark, copy)) == rows(store.read_store(spark, path))
    store.merge_into_store(spark, cells(spark, ("hour", "2026-02-01", "A", 3.0)), copy)
    assert rows(store.read_store(spark, copy), "date", "value") == [("2026-01-01", 1.0), ("2026-02-01", 3.0)]
