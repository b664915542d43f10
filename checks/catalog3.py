"""Registered queries, third part: a grid that grows, several sources, null keys, NaN, windows, stored locations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import tables as t
from checks.catalog import (
    _CHAIN, _EXACT_VIEWS, _FILL, _GAPS, _IMPUTE_SQL, _PREPARED_SQL, _PREPARED_VIEWS, _RATE, KEYS, PLACES, QUERIES, SQL, _chunk_filled,
    _chunks_sql, _filled, _imputed, _prepared, add, rounded,
)
from checks.catalog2 import _DS, _LOC, _inside_sql
from checks.tables import sql_hour_label
from smogline.functions.times import parse_time, run_window
from smogline.functions.values import nan_to_null
from smogline.operators import dataset, quality, rollup, series
from smogline.plans import locations, metric_run, store
from smogline.schema import SENSOR, MetricSpec
from smogline.session import scratch_path
from smogline.sources import boundaries
from smogline.streaming import ingest, upsert

# --- the series operators on a grid with gaps at every size -------------------------------

_LONG = {"gr": "SELECT * FROM lg", "grf": "SELECT * FROM lg"}
_AT = "\"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at"

add("w2_fill_single_gaps_long", lambda s, d: _filled(s, d, "exact", t.long_grid),
    f"SELECT {_AT}, round(value + 1e-9, {PLACES}) AS value FROM exact", **_EXACT_VIEWS, **_LONG)

add("w2_fill_single_gaps_window_long", lambda s, d: _filled(s, d, "window", t.long_grid),
    f"SELECT {_AT}, round({_FILL} + 1e-9, {PLACES}) AS value FROM gaps", gaps=_GAPS, **_LONG)

add("w4_fill_gap_chunks_long", lambda s, d: _chunk_filled(s, d, t.long_grid),
    f"SELECT {_AT}, round(value + 1e-9, {PLACES}) AS value FROM chunked", **_chunks_sql("gr"), **_LONG)

add("x1_qa_qc_impute_long", lambda s, d: _imputed(s, d, t.long_grid), _IMPUTE_SQL,
    **_EXACT_VIEWS, **_chunks_sql("exact"), **_RATE, **_LONG)

add("x2_prepare_minute_pm25_long", lambda s, d: _prepared(s, d, t.long_grid), _PREPARED_SQL, **_PREPARED_VIEWS, **_LONG)


def _no_source(spark, folder) -> DataFrame:
    """The growing grid, where one sensor has no source id."""
    return t.long_grid(spark, folder).withColumn("sourceId", F.when(F.col("datasourceId") != "o4", F.col("sourceId")))


_KEY = "concat_ws('||', {0}\"datasourceId\", {0}\"sourceId\")"


def _null_safe(views: dict[str, str]) -> dict[str, str]:
    """The views with the sensor's key as it is when the source is missing."""
    out = {}
    for name, sql in views.items():
        for alias in ("r.", "v.", ""):
            sql = sql.replace(f"{alias}\"datasourceId\" || '||' || {alias}\"sourceId\"", _KEY.format(alias))
        out[name] = sql
    return out


add("w4_fill_gap_chunks_no_source", lambda s, d: _chunk_filled(s, d, _no_source),
    f"SELECT {_AT}, round(value + 1e-9, {PLACES}) AS value FROM chunked", **_null_safe(_chunks_sql("gr")),
    gr="SELECT * REPLACE (CASE WHEN \"datasourceId\" <> 'o4' THEN \"sourceId\" END AS \"sourceId\") FROM lg")


def _timeless(s, d) -> DataFrame:
    """Places of readings of which some have a time that is none: each timed one's, and the range of the others'."""
    text = F.when(F.col("event_id") % 9 == 0, "soon").otherwise(F.date_format("endOfPeriod", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    rows = t.events(s, d).select("datasourceId", "event_id", parse_time(text).alias("time"))
    found = series.place_rows(rows, "time", keys=["datasourceId"], tie=[F.col("event_id")], segment_rows=50).df
    known = F.col("time").isNotNull()
    return found.groupBy("datasourceId", F.when(known, F.col("event_id")).alias("event_id")).agg(
        F.min("_pos").alias("low"), F.max("_pos").alias("high"), F.count_distinct("_pos").alias("places"))


add("w1_place_rows_timeless", _timeless,
    """SELECT "datasourceId", CASE WHEN time IS NOT NULL THEN event_id END AS event_id, min(pos) AS low, max(pos) AS high,
        count(DISTINCT pos) AS places FROM (SELECT *, row_number() OVER (PARTITION BY "datasourceId" ORDER BY time NULLS LAST, event_id) - 1 AS pos
        FROM (SELECT "datasourceId", event_id, CASE WHEN event_id % 9 <> 0 THEN "endOfPeriod" END AS time FROM ev)) GROUP BY ALL""")

# --- missing values and keys ---------------------------------------------------------------


def _with_nan(s, d) -> DataFrame:
    return t.events(s, d).withColumn("value", F.when(F.col("event_id") % 5 == 0, float("nan")).when(F.col("event_id") % 7 > 0, F.col("value")))


add("a1_rollup_hour_nan",
    lambda s, d: rounded(rollup.label_hours(rollup.rollup_hour(_with_nan(s, d), "endOfPeriod", "value", 2)), "metric"),
    f"""SELECT {KEYS}, {sql_hour_label('hour')} AS date, 'hour' AS type, round(avg(v) + 1e-9, {PLACES}) AS metric, count(v) AS n_valid,
        count(v) >= 2 AS is_valid FROM (SELECT *, date_trunc('hour', "endOfPeriod") AS hour,
        CASE WHEN event_id % 5 <> 0 AND event_id % 7 > 0 THEN value END AS v FROM ev) GROUP BY {KEYS}, hour""")

add("p4_filter_ranges_nan", lambda s, d: quality.filter_ranges(_with_nan(s, d), {"value": (20.0, 60.0)}).select("event_id"),
    "SELECT event_id FROM ev WHERE event_id % 5 = 0 OR event_id % 7 = 0 OR value BETWEEN 20 AND 60")


def _nan_grid(s, d, flat: bool = False) -> DataFrame:
    """The grid with every other missing value as NaN: results are those of nulls."""
    return t.grid(s, d, flat=flat).withColumn("value", F.coalesce("value", F.when(F.hour("time") % 2 == 0, float("nan"))))


def _nan_pivot(s, d) -> DataFrame:
    spoilt = _nan_grid(s, d).select(F.lit("hour").alias("type"), F.date_format("time", "yyyy-MM-dd HH").alias("date"), "datasourceId",
                                    F.lit("b").alias("sourceId"), F.col("value").alias("metric"))
    other = t.grid(s, d).select(F.lit("hour").alias("type"), F.date_format("time", "yyyy-MM-dd HH").alias("date"), "datasourceId",
                                F.lit("a").alias("sourceId"), F.lit(1.0).alias("metric"))
    return rounded(dataset.sensor_cells(spoilt.unionByName(other)), "value")


def _spoilt(name: str, fn) -> None:
    """A query whose results are those of ``name``."""
    QUERIES[f"{name}_nan"], SQL[f"{name}_nan"] = fn, SQL[name]


_spoilt("a9_missing_rate", lambda s, d: rounded(quality.missing_rate(_nan_grid(s, d), "value"), "missing_rate"))
_spoilt("p11_drop_missing",
    lambda s, d: rounded(quality.drop_missing(_nan_grid(s, d), "value").select("datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"),
                                                                               "value", "impute_flag"), "value"))
_spoilt("p5_drop_flatline",
    lambda s, d: rounded(series.drop_flatline(_nan_grid(s, d, flat=True), "time", "value").select(
        "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"), nan_to_null("value").alias("value")), "value"))
_spoilt("w1_rolling_sd",
    lambda s, d: series.rolling_sd(series.place_rows(_nan_grid(s, d, flat=True), "time"), "value").df.select(
        "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"), F.round("rolling_sd", 5).alias("sd")))
_spoilt("w2_fill_single_gaps", lambda s, d: _filled(s, d, "exact", _nan_grid))
_spoilt("w2_fill_single_gaps_window", lambda s, d: _filled(s, d, "window", _nan_grid))
_spoilt("w3_null_runs",
    lambda s, d: rounded(series.null_runs(series.place_rows(_nan_grid(s, d), "time"), "value"), "edge_before", "edge_after")
    .select("datasourceId", "start", "stop", "length", "edge_before", "edge_after"))
_spoilt("w4_fill_gap_chunks", lambda s, d: _chunk_filled(s, d, _nan_grid))
_spoilt("x1_qa_qc_impute", lambda s, d: _imputed(s, d, _nan_grid))
add("a11_sensor_cells_nan", _nan_pivot,
    f"""SELECT 'hour' AS type, strftime(time, '%Y-%m-%d %H') AS date, "datasourceId", round(max(coalesce(value, 1)) + 1e-9, {PLACES}) AS value
        FROM gr GROUP BY ALL""")



def _self_merged(s, d) -> DataFrame:
    table = t.table(s, d, "customer").select(
        F.col("c_custkey").alias("datasourceId"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey")).alias("sourceId"),
        F.col("c_name").alias("name"))
    return dataset.upsert_locations(dataset.upsert_locations(table, table), table)


add("j4_upsert_locations_self", _self_merged,
    'SELECT c_custkey AS "datasourceId", CASE WHEN c_custkey % 3 > 0 THEN c_nationkey END AS "sourceId", c_name AS name FROM customer')

# --- locations -----------------------------------------------------------------------------


def _layers(s, d) -> dict[str, DataFrame]:
    regions = t.regions(s, d)
    return {
        "wards": regions,
        "communities": regions.select("region_id", "x1", "y1", "x2", "y2", F.lower("ward").alias("community"), F.col("region_id").alias("comarea")),
        "zips": regions.filter(F.col("region_id").cast("int") % 2 == 0).select(
            "region_id", "x1", "y1", "x2", "y2", F.concat(F.lit("60"), "region_id").alias("zip"))}


def _all_layers(s, d) -> DataFrame:
    return locations.build_locations(t.wide(s, d), boundaries.flatten_datasources(t.datasources(s, d)), _layers(s, d), ["event_id"]) \
        .withColumn("tags", F.array_join("tags", ","))


add("x4_build_locations_layers", _all_layers,
    """SELECT l."datasourceId", l."sourceId", "currentSourceId", 'CLOUD' AS "sourceType", l.lat AS "locationLatitude",
        l.lon AS "locationLongitude", name, "group", tags, lower(c.ward) AS community, CAST(c.n_nationkey AS VARCHAR) AS comarea, i.ward,
        '60' || CAST(z.n_nationkey AS VARCHAR) AS zip FROM loc l LEFT JOIN ds USING ("datasourceId")
        LEFT JOIN inside i ON i."datasourceId" = l."datasourceId" AND i."sourceId" = l."sourceId"
        LEFT JOIN inside c ON c."datasourceId" = l."datasourceId" AND c."sourceId" = l."sourceId"
        LEFT JOIN inside z ON z."datasourceId" = l."datasourceId" AND z."sourceId" = l."sourceId" AND z.n_nationkey % 2 = 0""",
    loc=_LOC, ds=_DS, inside=_inside_sql("loc", "lon", "lat", KEYS))


def _stored_locations(s, d) -> DataFrame:
    """The location table after two runs over the same readings and a supplied table with new names."""
    path, supplied = scratch_path(s, "locations"), scratch_path(s, "supplied")
    for _ in range(2):
        locations.update_locations(s, path, t.wide(s, d), boundaries.flatten_datasources(t.datasources(s, d)),
                                   {"wards": t.regions(s, d)}, ["event_id"])
    (t.events(s, d).select("datasourceId", F.lit("S1").alias("sourceId"), F.upper("datasourceId").alias("name"), F.lit(None).cast("string").alias("ward"))
     .distinct().write.parquet(supplied))
    return locations.merge_location_file(s, path, supplied).select(
        *SENSOR, "locationLatitude", "locationLongitude", "name", "ward")


add("x4_merge_locations", _stored_locations,
    """SELECT l."datasourceId", l."sourceId", l.lat AS "locationLatitude", l.lon AS "locationLongitude",
        any_value(CASE WHEN l."sourceId" = 'S1' THEN upper(l."datasourceId") ELSE ds.name END) AS name, min(i.ward) AS ward
        FROM loc l LEFT JOIN ds USING ("datasourceId") LEFT JOIN inside i ON i."datasourceId" = l."datasourceId" AND i."sourceId" = l."sourceId"
        GROUP BY l."datasourceId", l."sourceId", l.lat, l.lon""", loc=_LOC, ds=_DS, inside=_inside_sql("loc", "lon", "lat", KEYS))

# --- runs ----------------------------------------------------------------------------------

_SPEC = MetricSpec("air", t.VALUE, qc=True)
_UNEVEN_VIEWS = {
    "hours": f"""SELECT {KEYS}, date_trunc('hour', "endOfPeriod") AS hour, count(value) AS n_valid, avg(value) AS metric
        FROM un WHERE qc IS DISTINCT FROM 'invalid' GROUP BY ALL""",
    "days": f"SELECT {KEYS}, date_trunc('day', hour) AS day, count(*) AS n_valid, avg(metric) AS metric FROM hours GROUP BY ALL",
    "vdays": "SELECT * FROM days WHERE n_valid > 20", "chain": _CHAIN,
}
_UNEVEN_SQL = f"""SELECT type, date, "datasourceId", round(arg_max(metric, "sourceId") + 1e-9, {PLACES}) AS value
    FROM chain WHERE is_valid GROUP BY ALL"""


def _cells_of(stored: DataFrame) -> DataFrame:
    return rounded(stored, "value").select("type", "date", "datasourceId", "value")


def _refreshed_sources(s, d) -> DataFrame:
    """Readings of three sources in two halves, each run renewing what it touches."""
    rows, path = t.uneven(s, d), scratch_path(s, "store")
    half = F.col("endOfPeriod") < F.lit(datetime(2024, 1, 17, 11))
    metric_run.run_metric(s, _SPEC, rows.filter(half), path, refresh=True)
    return _cells_of(metric_run.run_metric(s, _SPEC, rows.filter(~half), path, refresh=True))


add("x5_run_metric_refresh_sources", _refreshed_sources, _UNEVEN_SQL, **_UNEVEN_VIEWS)

add("x5_run_metric_sources", lambda s, d: _cells_of(metric_run.run_metric(s, _SPEC, t.uneven(s, d), scratch_path(s, "store"))),
    _UNEVEN_SQL, **_UNEVEN_VIEWS)


def _windowed(s, d) -> DataFrame:
    """A historical run over the largest of the asked levels: the week before."""
    root = scratch_path(s, "windowed")
    rows = t.wide(s, d).withColumn("sourceId", F.upper("datasourceId"))
    stored = metric_run.run_metrics(s, lambda _: rows, root, ["hourly_pm25"],
                                    window=run_window(datetime(2024, 1, 24, 5), True, ["day", "week", "hour"]))
    return _cells_of(stored["hourly_pm25"].filter("type = 'hour'"))


add("x5_run_window", _windowed,
    f"""SELECT 'hour' AS type, {sql_hour_label('hour')} AS date, "datasourceId", round(metric + 1e-9, {PLACES}) AS value FROM hours
        WHERE "datasourceId" <> 'error' AND hour >= TIMESTAMP '2024-01-15' AND hour < TIMESTAMP '2024-01-22'""")


def _offsets(s, d) -> DataFrame:
    """The offset index of a store, from the counts kept per partition."""
    path = scratch_path(s, "store")
    metric_run.run_metric(s, _SPEC, t.uneven(s, d), path)
    return store.store_offsets(s, path)


add("s12_store_offsets", _offsets,
    """SELECT t.type, CAST(CASE WHEN EXISTS (SELECT 1 FROM cells WHERE cells.type = t.type) THEN (SELECT coalesce(sum(n), 0) FROM
        (SELECT type, count(DISTINCT date) AS n FROM cells GROUP BY type) c JOIN ranks USING (type) WHERE ranks.rank < t.rank) ELSE 0 END AS BIGINT) AS first_row
        FROM ranks t""", cells=_UNEVEN_SQL,
    ranks="SELECT * FROM (VALUES ('hour', 0), ('day', 1), ('week', 2), ('month', 3), ('season', 4), ('year', 5)) AS r(type, rank)", **_UNEVEN_VIEWS)

_STREAMED = T.StructType([
    T.StructField("datasourceId", T.StringType()), T.StructField("sourceId", T.StringType()), T.StructField("endOfPeriod", T.TimestampType()),
    T.StructField(t.VALUE, T.DoubleType()), T.StructField(t.ASSESSMENT, T.StringType())])


def _streamed_metric(s, d) -> DataFrame:
    """Files landing in time order, streamed into a store with all its levels, invalid readings left out."""
    landing, target, state = (scratch_path(s, n) for n in ("landing", "store", "state"))
    (t.uneven(s, d).select(*[F.col(f"`{c}`") for c in _STREAMED.names]).repartitionByRange(4, "endOfPeriod").write.parquet(landing))
    rows = ingest.stream_measurements(s, landing, _STREAMED, "parquet", files_per_batch=2)
    upsert.stream_metric(rows, _SPEC, target, state, "60 days").awaitTermination()
    return _cells_of(store.read_store(s, target))


add("t3_stream_metric", _streamed_metric, _UNEVEN_SQL, **_UNEVEN_VIEWS)
