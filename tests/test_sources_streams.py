import gzip
import json
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.schema import CELL, DATASOURCES, SENSOR, SOURCE_CELL
from smogline.sources import boundaries, measurements, sinks, versions
from smogline.streaming import ingest, upsert
from smogline.plans import store
from smogline.operators import rollup

SCHEMA = T.StructType([T.StructField("datasourceId", T.StringType()), T.StructField("x.value", T.DoubleType()),
                       T.StructField("n", T.IntegerType())])


def write(folder, name, text, packed=False):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with (gzip.open(path, "wt") if packed else open(path, "w")) as f:
        f.write(text)
    return path


def test_wide_rows(spark, shared):
    path = write(shared("csv"), "a.csv", "Unnamed: 0,x.value,datasourceId,y.raw\n0,1.5,A,7\n1,NaN,B,\n2,,C,2\n")
    df = measurements.read_measurements_wide(spark, path, SCHEMA)
    assert df.columns == ["x.value", "datasourceId", "y.raw", "n"]
    assert rows(df) == [(1.5, "A", 7.0, None), (None, "B", None, None), (None, "C", 2.0, None)]


def test_report_parts(spark, shared):
    folder = shared("parts")
    one = write(folder, "1.csv.gz", "datasourceId,x.value\nA,1\nA,1\n", packed=True)
    two = write(folder, "2.csv", "x.value,datasourceId,extra\nNaN,B,e\n")
    three = write(folder, "3.csv", "datasourceId,x.value\nC,3\n")
    df = measurements.read_report_parts(spark, [one, two, three], SCHEMA)
    assert rows(df, "datasourceId", "`x.value`", "extra") == [("A", 1.0, None), ("A", 1.0, None), ("B", None, "e"), ("C", 3.0, None)]


def test_long_response_without_locations(spark, shared):
    row = {"datasourceId": "A", "time": "t", "metric": "m", "value": 1, "raw": None, "status": "ok"}
    path = write(shared("json"), "r.json", json.dumps({"request": {}, "data": [row, row]}, indent=1))
    data, places = measurements.read_measurements_long(spark, path)
    assert data.count() == 2 and places.count() == 0


def test_datasources(spark):
    df = spark.createDataFrame([("A", "s", "c", ("n", None, ["t"]))], DATASOURCES)
    flat = boundaries.flatten_datasources(df)
    assert rows(flat) == [("A", "s", "c", "n", None, ["t"])]


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def test_boundaries(spark, shared):
    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    layer = {"type": "FeatureCollection", "features": [
        feature("Polygon", [ring, ring], community="LOOP", area_numbe="32", extra=1),
        feature("MultiPolygon", [[ring], [ring]], community="ELSE", area_numbe=5)]}
    path = write(shared("geo"), "c.geojson", json.dumps(layer, indent=2))
    edges = boundaries.read_boundaries(spark, path, "communities")
    assert edges.columns == ["layer", "region_id", "community", "comarea", "part", "ring", "seq", "x1", "y1", "x2", "y2"]
    assert edges.count() == 12
    assert rows(edges.groupBy("community", "comarea", "part", "ring").count()) == [
        ("ELSE", "5", 0, 0, 3), ("ELSE", "5", 1, 0, 3), ("LOOP", "32", 0, 0, 3), ("LOOP", "32", 0, 1, 3)]
    assert rows(edges.filter("community = 'LOOP' and ring = 0"), "seq", "x1", "y1", "x2", "y2")[1] == (1, 4.0, 0.0, 4.0, 4.0)


def test_snapshot_refuses_an_existing_copy(spark, shared):
    source, root = shared("src"), shared("snap")
    spark.createDataFrame([("day", 1)], "type string, v int").write.partitionBy("type").parquet(source)
    target = sinks.snapshot_dataset(spark, {"d": source}, root, "now")
    assert rows(spark.read.parquet(f"{target}/d"), "type", "v") == [("day", 1)]
    with pytest.raises(FileExistsError):
        sinks.snapshot_dataset(spark, {"d": source}, root, "now")


def test_unknown_summary_format(spark, shared):
    path = shared("summary")
    assert not sinks.write_summaries(spark.createDataFrame([("day", 1)], "type string, v int"), path, "xlsx")
    assert not os.path.exists(path)


READING = T.StructType([T.StructField("datasourceId", T.StringType()), T.StructField("sourceId", T.StringType()),
                        T.StructField("ts", T.TimestampType()), T.StructField("v", T.DoubleType())])


def land(spark, folder, name, *readings):
    text = "datasourceId,sourceId,ts,v\n" + "".join(f"A,S,{ts},{v}\n" for ts, v in readings)
    write(folder, name, text)


def test_files_are_read_once(spark, shared):
    landing, out, state = shared("landing"), shared("out"), shared("state")
    land(spark, landing, "1.csv", ("2026-01-01T00:10:00Z", 1.0), ("2026-01-01T00:20:00Z", "NaN"))
    rows_in = ingest.stream_measurements(spark, landing, READING)
    ingest.run_available(rows_in, out, state)
    ingest.run_available(rows_in, out, state)
    land(spark, landing, "2.csv", ("2026-01-01T01:10:00Z", 2.0))
    ingest.run_available(rows_in, out, state)
    assert sorted((r["v"] for r in spark.read.parquet(out).collect()), key=repr) == [1.0, 2.0, None]


def test_late_rows_amend_or_are_dropped(spark, shared):
    landing, target, state = shared("landing"), shared("store"), shared("state")

    def run():
        hours = ingest.stream_hourly(ingest.stream_measurements(spark, landing, READING), "ts", "v", "3 hours")
        upsert.stream_upsert(hours, target, state).awaitTermination()
        return dict(rows(store.read_store(spark, target).filter("type = 'hour'"), "date", "value"))

    land(spark, landing, "1.csv", ("2026-01-01T05:10:00Z", 1.0))
    assert run() == {"2026-01-01 05:00:00": 1.0}
    land(spark, landing, "2.csv", ("2026-01-01T06:10:00Z", 7.0), ("2026-01-01T05:50:00Z", 3.0))
    assert run() == {"2026-01-01 05:00:00": 2.0, "2026-01-01 06:00:00": 7.0}
    land(spark, landing, "3.csv", ("2026-01-01T12:10:00Z", 9.0))
    run()
    land(spark, landing, "4.csv", ("2026-01-01T05:55:00Z", 100.0), ("2026-01-01T12:20:00Z", 11.0))
    assert run() == {"2026-01-01 05:00:00": 2.0, "2026-01-01 06:00:00": 7.0, "2026-01-01 12:00:00": 10.0}


def test_replayed_batch_changes_nothing(spark, shared):
    target = shared("store")
    readings = spark.createDataFrame([("A", "S", 2.0)], "datasourceId string, sourceId string, v double").withColumn(
        "ts", F.to_timestamp(F.lit("2026-01-01 05:10:00")))
    batch = rollup.rollup_hour(readings, "ts", "v")
    upsert.upsert_batch(batch, target)
    before = rows(store.read_store(spark, target))
    upsert.upsert_batch(batch, target)
    assert rows(store.read_store(spark, target)) == before == [("hour", "2026-01-01 05:00:00", "A", 2.0, "2026-01-01")]


def test_streamed_metric_equals_a_refreshing_run(spark, shared, folder):
    """The same files by a stream in several batches and by one run: hours to years, quality filter included."""
    from checks import tables
    from smogline.plans import metric_run
    from smogline.schema import MetricSpec

    spec = MetricSpec("air", tables.VALUE, qc=True)
    columns = ["datasourceId", "sourceId", "endOfPeriod", tables.VALUE, tables.ASSESSMENT]
    readings = tables.wide(spark, folder).select(*[F.col(f"`{c}`") for c in columns])
    landing, streamed, batch = shared("landing"), shared("streamed"), shared("batch")
    readings.repartitionByRange(5, "endOfPeriod").write.parquet(landing)
    stream = ingest.stream_measurements(spark, landing, readings.schema, "parquet", files_per_batch=2)
    upsert.stream_metric(stream, spec, streamed, shared("state"), "60 days").awaitTermination()
    metric_run.run_metric(spark, spec, spark.read.parquet(landing), batch, refresh=True)
    def rounded(path):
        return rows(store.read_store(spark, path).withColumn("value", F.round("value", 9)))
    got = rounded(streamed)
    assert got == rounded(batch) and {r[0] for r in got} >= {"hour", "day"}
    assert not [r for r in got if r[2] == "error"]


def test_stream_and_batch_agree(spark, folder):
    from checks import catalog2, tables

    streamed = rows(catalog2._streamed_hours(spark, folder))
    batch = rollup.label_hours(rollup.rollup_hour(tables.events(spark, folder), "endOfPeriod", "value"))
    assert streamed == rows(batch.select(*SENSOR, "date", "n_valid", catalog2.near("metric").alias("metric"), "is_valid"))


class Session:
    """As much of a session as naming the shared folder needs."""

    def __init__(self, master, **settings):
        from types import SimpleNamespace

        self.conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: None)


def test_shared_folder_follows_the_session(spark):
    from smogline.session import shared_dir

    assert shared_dir(Session("yarn", **{"spark.checkpoint.dir": "/shared/x/"})) == "/shared/x"
    with pytest.raises(RuntimeError):
        shared_dir(Session("yarn"))
    assert shared_dir(spark) == shared_dir(spark)


def files_of(path):
    import glob

    return {f for f in glob.glob(f"{path}/**", recursive=True) if os.path.isfile(f)}


def one_hour(spark, hour, value):
    readings = spark.createDataFrame([("A", "S", value)], "datasourceId string, sourceId string, v double").withColumn(
        "ts", F.to_timestamp(F.lit(f"{hour}:10:00")))
    return rollup.rollup_hour(readings, "ts", "v")


def test_a_batch_counts_once_per_stream(spark, shared):
    """A replay writes no file, also after another writer has changed the cell; another stream's batch counts."""
    target = shared("store")
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 2.0), target, "s", 0)
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 7.0), target)
    before = files_of(target)
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 2.0), target, "s", 0)
    assert files_of(target) == before
    assert rows(store.read_store(spark, target), "value") == [(7.0,)]
    upsert.upsert_batch(one_hour(spark, "2026-01-01 06", 3.0), target, "s", 1)
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 4.0), target, "other", 0)
    assert versions.marks(spark, target) == {"s": 1, "other": 0}
    assert rows(store.read_store(spark, target), "date", "value") == [("2026-01-01 05:00:00", 4.0), ("2026-01-01 06:00:00", 3.0)]


def test_an_empty_batch_is_recorded(spark, shared):
    target = shared("store")
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 2.0).limit(0), target, "s", 0)
    assert versions.marks(spark, target) == {"s": 0} and store.read_store(spark, target).isEmpty()


def test_a_stream_leaves_its_mark(spark, shared):
    landing, target, state = shared("landing"), shared("store"), shared("state")
    for name, hour in (("1.csv", "05"), ("2.csv", "06")):
        land(spark, landing, name, (f"2026-01-01T{hour}:10:00Z", 1.0))
        hours = ingest.stream_hourly(ingest.stream_measurements(spark, landing, READING), "ts", "v", "3 hours")
        query = upsert.stream_upsert(hours, target, state)
        query.awaitTermination()
    found = versions.marks(spark, target)
    assert list(found) == [str(query.id)] and found[str(query.id)] >= 1


def test_a_run_stopped_between_two_writes_changes_nothing(spark, shared, monkeypatch):
    """Hours of sources, days of sources and cells: whichever write is the last one, readers see the state before."""
    target = shared("store")
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 2.0), target, "s", 0)

    def state():
        return [rows(store.read_store(spark, target, keys=keys), "type", "date", "value") for keys in (CELL, SOURCE_CELL)] + [
            rows(store.store_offsets(spark, target)), versions.marks(spark, target)]

    before, plain = state(), versions.write
    for allowed in range(4):
        done = []

        def write(*args):
            if len(done) == allowed:
                raise KeyboardInterrupt
            done.append(args)
            plain(*args)

        with monkeypatch.context() as m:
            m.setattr(versions, "write", write)
            if allowed == 3:  # all is written, the list is not
                m.setattr(versions, "publish", lambda *_: write())
            with pytest.raises(KeyboardInterrupt):
                upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 9.0), target, "s", 1)
        assert state() == before
    upsert.upsert_batch(one_hour(spark, "2026-01-01 05", 9.0), target, "s", 1)
    assert rows(store.read_store(spark, target), "value") == [(9.0,)] and versions.marks(spark, target) == {"s": 1}


def test_a_batch_rewrites_its_day_of_hours_only(spark, shared):
    target = shared("store")
    for hour in ("2026-01-01 05", "2026-01-02 05"):
        upsert.upsert_batch(one_hour(spark, hour, 2.0), target)
    before = files_of(f"{target}/type=hour/bucket=2026-01-01") | files_of(f"{target}/_sources/type=hour/bucket=2026-01-01")
    assert before
    upsert.upsert_batch(one_hour(spark, "2026-01-02 07", 3.0), target)
    assert before == files_of(f"{target}/type=hour/bucket=2026-01-01") | files_of(f"{target}/_sources/type=hour/bucket=2026-01-01")
    assert store.read_store(spark, target).count() == 3


def test_headers_of_many_parts(spark, shared):
    """Parts are grouped by their first lines, without a job each; quoted, empty and folder parts included."""
    folder = shared("parts")
    parts = [write(folder, f"{i}.csv{'.gz' * (i % 2)}", f"datasourceId,x.value\nA,{i}\n", packed=i % 2) for i in range(40)]
    parts += [write(folder, "q.csv", '"datasourceId","x.value"\nB,1\n'), write(folder, "e.csv", "")]
    write(f"{folder}/inner", "1.csv", "x.value,datasourceId\n5,C\n")
    groups = measurements.by_header(spark, [*parts, f"{folder}/inner"])
    assert sorted(map(len, groups)) == [1, 1, 1, 40]
    df = measurements.read_report_parts(spark, [*parts, f"{folder}/inner"], SCHEMA)
    assert rows(df.groupBy("datasourceId").agg(F.sum("`x.value`"))) == [("A", 780.0), ("B", 1.0), ("C", 5.0)]
