"""Registered queries, second part: joins, functions, sources and sinks, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import tables as t
from checks.catalog import _CELLS3, KEYS, PLACES, _cells, add, near, rounded
from checks.tables import sql_haversine, sql_hour_label, sql_label, sql_season
from smogline.functions import features as fjson
from smogline.functions import geo, labels, times, values
from smogline.operators import candidates, dataset, features, rollup, spatial
from smogline.plans import locations, store
from smogline.schema import CELLS, FEATURE_METRICS, MEASUREMENT_IDS, SENSOR
from smogline.session import scratch_path
from smogline.sources import boundaries, measurements, sinks
from smogline.streaming import ingest, upsert

# --- locations ---------------------------------------------------------------------------

_DS = """SELECT event_type AS "datasourceId", 'sub-' || event_type AS "currentSubscriptionId",
    'cur-' || upper(event_type) AS "currentSourceId", upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS name,
    CASE WHEN length(event_type) > 5 THEN 'long' END AS "group", 'tag,' || event_type AS tags
    FROM (SELECT DISTINCT event_type FROM events) WHERE event_type <> 'view'"""
_LOC = f"""SELECT {KEYS}, round_even(lat, 4) AS lat, round_even(lon, 4) AS lon FROM ev
    QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY event_id) = 1"""
_CROSS = "((x2 - x1) * (p.{y} - y1) - (p.{x} - x1) * (y2 - y1))"


def _inside_sql(points: str, x: str, y: str, key: str) -> str:
    """Keys of the points inside a region (even-odd, borders outside), brute force."""
    turn = _CROSS.format(x=x, y=y)
    return f"""SELECT {key}, n_nationkey, ward FROM {points} p, re GROUP BY ALL
        HAVING sum(CASE WHEN (y1 <= p.{y} AND p.{y} < y2 AND {turn} > 0) OR (y2 <= p.{y} AND p.{y} < y1 AND {turn} < 0)
                   THEN 1 ELSE 0 END) % 2 = 1
        AND NOT bool_or({turn} = 0 AND p.{x} BETWEEN least(x1, x2) AND greatest(x1, x2)
                        AND p.{y} BETWEEN least(y1, y2) AND greatest(y1, y2))"""


def _joined(s, d) -> DataFrame:
    found = locations.join_datasources(locations.project_locations(t.wide(s, d), ["event_id"]),
                                       boundaries.flatten_datasources(t.datasources(s, d)))
    return found.withColumn("tags", F.array_join("tags", ","))


add("j1_join_datasources", _joined,
    f"""SELECT l."datasourceId", l."sourceId", 'CLOUD' AS "sourceType", l.lat AS "locationLatitude", l.lon AS "locationLongitude",
        "currentSubscriptionId", "currentSourceId", name, "group", tags FROM loc l LEFT JOIN ds USING ("datasourceId")""",
    loc=_LOC, ds=_DS)

add("s9_flatten_datasources",
    lambda s, d: boundaries.flatten_datasources(t.datasources(s, d)).withColumn("tags", F.array_join("tags", ",")),
    "SELECT * FROM ds", ds=_DS)

add("j2_assign_regions",
    lambda s, d: spatial.assign_regions(t.places(s, d), t.regions(s, d), ["ward"], "lon", "lat").select("key", "ward"),
    "SELECT p.key, i.ward FROM pl p LEFT JOIN inside i USING (key)", inside=_inside_sql("pl", "lon", "lat", "key"))

add("x4_build_locations",
    lambda s, d: locations.build_locations(
        t.wide(s, d), boundaries.flatten_datasources(t.datasources(s, d)), {"wards": t.regions(s, d)}, ["event_id"])
    .withColumn("tags", F.array_join("tags", ",")),
    """SELECT l."datasourceId", l."sourceId", "currentSourceId", 'CLOUD' AS "sourceType", l.lat AS "locationLatitude",
        l.lon AS "locationLongitude", name, "group", tags, CAST(NULL AS VARCHAR) AS community, CAST(NULL AS VARCHAR) AS comarea,
        i.ward, CAST(NULL AS VARCHAR) AS zip FROM loc l LEFT JOIN ds USING ("datasourceId")
        LEFT JOIN inside i ON i."datasourceId" = l."datasourceId" AND i."sourceId" = l."sourceId" """,
    loc=_LOC, ds=_DS, inside=_inside_sql("loc", "lon", "lat", KEYS))

add("j4_upsert_locations",
    lambda s, d: dataset.upsert_locations(
        t.table(s, d, "customer").select(F.col("c_custkey").alias("datasourceId"), F.col("c_nationkey").alias("sourceId"),
                                         F.col("c_name").alias("name"), F.col("c_mktsegment").alias("zip")),
        t.table(s, d, "customer").select(
            (F.col("c_custkey") * 2).alias("datasourceId"), F.col("c_nationkey").alias("sourceId"),
            F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"), F.col("c_acctbal").alias("lat"))),
    """SELECT coalesce(n.a, o.a) AS "datasourceId", coalesce(n.b, o.b) AS "sourceId", coalesce(n.name, o.name) AS name, n.lat, o.zip FROM
        (SELECT c_custkey * 2 AS a, c_nationkey AS b, CASE WHEN c_acctbal > 0 THEN c_name END AS name, c_acctbal AS lat FROM customer) n
        FULL JOIN (SELECT c_custkey AS a, c_nationkey AS b, c_name AS name, c_mktsegment AS zip FROM customer) o ON n.a = o.a AND n.b = o.b""")

# --- candidate sites ---------------------------------------------------------------------

_MATCH = "p.sensor = s.sensor AND p.area = s.area AND p.ward = s.ward AND p.zip = s.zip"
_FIRST = "SELECT *, lat::VARCHAR || ', ' || lon::VARCHAR AS code FROM po QUALIFY row_number() OVER (PARTITION BY sensor, candidate, area, ward, zip ORDER BY ord) = 1"

add("j7_fill_candidates", lambda s, d: candidates.fill_candidates(t.sites(s, d), t.poles(s, d)),
    'SELECT s.sensor AS "EPA Grid Point ID", CAST(s.zip AS INTEGER) AS "Zipcode", CAST(s.area AS INTEGER) AS "Community Area Number", '
    'CAST(s.ward AS INTEGER) AS "Ward Number", '
    + ", ".join(f'any_value({c}) FILTER (candidate = {p}) AS "{name.format(p)}"' for p in candidates.PRIORITIES
                for c, name in zip(("fid", "code", "addr"), candidates.FILLED.values()))
    + f" FROM si s LEFT JOIN firsts p ON {_MATCH} GROUP BY s.sensor, s.zip, s.area, s.ward", firsts=_FIRST)

add("j8_unmatched_candidates", lambda s, d: candidates.unmatched_candidates(t.sites(s, d), t.poles(s, d)),
    'SELECT s.sensor AS "EPA Grid Point ID", CAST(s.zip AS INTEGER) AS "Zipcode", CAST(s.area AS INTEGER) AS "Community Area Number", '
    'CAST(s.ward AS INTEGER) AS "Ward Number", c."Candidate" FROM si s, (VALUES (1), (2), (3), (4), (5)) AS c("Candidate") '
    f'WHERE NOT EXISTS (SELECT 1 FROM po p WHERE {_MATCH} AND p.candidate = c."Candidate")')

add("f16_geocode",
    lambda s, d: t.poles(s, d).select("_ord", geo.geocode("Latitude", F.when(F.col("Ward") > 3, F.col("Longitude"))).alias("code")),
    "SELECT ord AS _ord, lat::VARCHAR || ', ' || CASE WHEN ward > 3 THEN lon END::VARCHAR AS code FROM po")

# --- features ----------------------------------------------------------------------------

_LATEST_SQL = "SELECT \"datasourceId\", max(time) AS time, " + ", ".join(
    f"max(value) FILTER (metric = '{m}' AND value IS NOT NULL AND time = tm_{i}) AS \"{m}\"" for i, m in enumerate(FEATURE_METRICS)) \
    + " FROM (SELECT *, " + ", ".join(
    f"max(time) FILTER (metric = '{m}' AND value IS NOT NULL) OVER (PARTITION BY \"datasourceId\") AS tm_{i}"
    for i, m in enumerate(FEATURE_METRICS)) + " FROM lo) GROUP BY \"datasourceId\""

add("a14_latest_by_metric", lambda s, d: features.latest_by_metric(t.long_rows(s, d)), _LATEST_SQL)

_HISTORY_SQL = 'SELECT "datasourceId", metric, time, arg_max(struct_pack(v := value), event_id).v AS value FROM lo GROUP BY ALL'

add("a15_history_rows", lambda s, d: features.history_rows(t.long_rows(s, d), "event_id"), _HISTORY_SQL)


def _history_maps(s, d) -> DataFrame:
    """The maps opened up again: one row per entry, and the number of empty maps."""
    maps = features.history_by_metric(t.long_rows(s, d), "event_id")
    return maps.select("datasourceId", "part", *[
        F.concat_ws(";", F.transform(F.map_entries(F.col(m)), lambda e: F.concat(
            e["key"], F.lit("="), F.coalesce((F.round(e["value"] * 100)).cast("bigint").cast("string"), F.lit("?"))))).alias(m)
        for m in FEATURE_METRICS])


add("a15_history_by_metric", _history_maps,
    'SELECT "datasourceId", substr(time, 1, 10) AS part, ' + ", ".join(
        f"coalesce(string_agg(time || '=' || coalesce(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), '?'), ';' ORDER BY time) "
        f"FILTER (metric = '{m}'), '') AS \"{m}\"" for m in FEATURE_METRICS)
    + " FROM history GROUP BY ALL", history=_HISTORY_SQL)


def _user_places(s, d) -> DataFrame:
    """A place for every customer; events know some of them as users."""
    return t.table(s, d, "customer").select(
        F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("datasourceId"),
        (t.as_double("c_custkey") / 64 + 41).alias("lat"), (t.as_double("c_nationkey") / 8 - 88).alias("lon"))


_PLACES = ("SELECT 'D' || CAST(c_custkey AS VARCHAR) AS \"datasourceId\", CAST(c_custkey AS DOUBLE) / 64 + 41 AS lat, "
           "CAST(c_nationkey AS DOUBLE) / 8 - 88 AS lon FROM customer")


def _features(s, d) -> DataFrame:
    made = features.features_with_geometry(features.latest_by_metric(t.long_rows(s, d)), _user_places(s, d), "2024-02-01")
    shape = ("type string, properties struct<datasourceId: string, time: string, pm2_5ConcMassNowcast: double>, "
             "geometry struct<type: string, coordinates: array<double>>")
    f = F.from_json("feature", shape)
    return made.select("datasourceId", "timestamp", f["type"].alias("kind"), f["properties"]["datasourceId"].alias("id"),
                       f["properties"]["time"].alias("time"), f["properties"]["pm2_5ConcMassNowcast"].alias("pm25"),
                       f["geometry"]["type"].alias("shape"), f["geometry"]["coordinates"][0].alias("x"),
                       f["geometry"]["coordinates"][1].alias("y"),
                       F.col("feature").contains('"pm10ConcMassNowcast":').alias("spells_nulls"))


add("j9_features_with_geometry", _features,
    """SELECT "datasourceId", '2024-02-01' AS timestamp, 'Feature' AS kind, "datasourceId" AS id, time, "pm2_5ConcMassNowcast" AS pm25,
        'Point' AS shape, lon AS x, lat AS y, true AS spells_nulls FROM latest JOIN place USING ("datasourceId")""",
    latest=_LATEST_SQL, place=_PLACES)

add("j9_missing_properties",
    lambda s, d: features.missing_properties(features.latest_by_metric(t.long_rows(s, d)), _user_places(s, d)),
    'SELECT count(*) AS locations_without_properties FROM place WHERE "datasourceId" NOT IN (SELECT "datasourceId" FROM lo)', place=_PLACES)

add("f20_to_geojson_feature",
    lambda s, d: t.places(s, d).select("key", fjson.json_text(fjson.to_geojson_feature(
        F.struct("key", F.lit(None).cast("string").alias("note")), F.floor("lon"), F.floor("lat"))).alias("feature")),
    """SELECT key, '{"type":"Feature","properties":{"key":"' || key || '","note":null},"geometry":{"type":"Point","coordinates":[' ||
        CAST(CAST(floor(lon) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(floor(lat) AS BIGINT) AS VARCHAR) || ']}}' AS feature FROM pl""")

# --- functions ---------------------------------------------------------------------------

_SEC = "%Y-%m-%d %H:%M:%S"


def _text(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


add("f1_floors", lambda s, d: t.table(s, d, "events").select(
    "event_id", _text(labels.floor_hour("ts")).alias("h"), _text(labels.floor_day("ts")).alias("d")),
    f"SELECT event_id, strftime(date_trunc('hour', ts), '{_SEC}') AS h, strftime(date_trunc('day', ts), '{_SEC}') AS d FROM events")

add("f2_hour_label", lambda s, d: t.table(s, d, "events").select("event_id", labels.hour_label("ts").alias("label")),
    f"SELECT event_id, {sql_hour_label('h')} AS label FROM (SELECT event_id, date_trunc('hour', ts) AS h FROM events)")

for _id, _level in (("f3", "week"), ("f4", "month"), ("f5", "season"), ("f6", "year")):
    add(f"{_id}_{_level}_label",
        lambda s, d, level=_level: t.table(s, d, "lineitem").select(
            "l_shipdate", labels.LABELS[level]("l_shipdate").alias("label")).distinct()
        .select(_text("l_shipdate").alias("day"), "label"),
        f"SELECT DISTINCT strftime(l_shipdate, '{_SEC}') AS day, {sql_label(_level, 'l_shipdate')} AS label FROM lineitem")

add("f7_parse_time",
    lambda s, d: t.table(s, d, "events").select("event_id", _text(times.parse_time(
        F.when(F.col("event_type") == "view", "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))).alias("at")),
    f"SELECT event_id, CASE WHEN event_type <> 'view' THEN strftime(ts, '{_SEC}') END AS at FROM events")

add("f8_format_iso", lambda s, d: t.table(s, d, "events").select("event_id", times.format_iso("ts").alias("at")),
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS at FROM events")

_STARTS = {"day": "date_trunc('day', {0})", "week": "date_trunc('week', {0})", "month": "date_trunc('month', {0})",
           "season": "date_trunc('month', {0}) - to_months(CAST(month({0}) % 3 AS INTEGER))", "year": "date_trunc('year', {0})"}
_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH", "season": "INTERVAL 3 MONTH",
         "year": "INTERVAL 1 YEAR"}

add("f9_period_start",
    lambda s, d: t.table(s, d, "orders").select("o_orderdate").distinct().select(
        _text("o_orderdate").alias("day"),
        *[_text(times.period_start(k, "o_orderdate", n)).alias(f"{k}_{w}")
          for k in _STARTS for n, w in ((-1, "before"), (0, "start"), (1, "stop"))]),
    f"SELECT DISTINCT strftime(o_orderdate, '{_SEC}') AS day, " + ", ".join(
        f"strftime({_STARTS[k].format('o_orderdate')} {op}, '{_SEC}') AS {k}_{w}" for k in _STARTS
        for op, w in ((f"- {_STEP[k]}", "before"), ("", "start"), (f"+ {_STEP[k]}", "stop"))) + " FROM orders")

add("f10_season_of", lambda s, d: t.table(s, d, "orders").select("o_orderkey", labels.season_of("o_orderdate").alias("season")),
    f"SELECT o_orderkey, {sql_season('o_orderdate')} AS season FROM orders")

add("f11_haversine_km",
    lambda s, d: t.places(s, d).select("key", F.round(geo.haversine_km("lat", "lon", F.lit(41.8), F.lit(-87.6)), 6).alias("km")),
    f"SELECT key, round({sql_haversine('lat', 'lon', '41.8e0', '-87.6e0')}, 6) AS km FROM pl")

add("f12_calibrate_pm25",
    lambda s, d: t.events(s, d).select("event_id", F.round(values.calibrate_pm25(
        "value", F.when(F.col("qc").isNotNull(), t.as_double("user_id") % 100)) + 1e-9, PLACES).alias("calibrated")),
    f"""SELECT event_id, round(CASE WHEN value < 343 THEN 0.524e0 * value - 0.0862e0 * CASE WHEN qc IS NOT NULL THEN user_id % 100 END + 5.75e0
        WHEN value >= 343 THEN 0.46e0 * value + 0.000393e0 * value * value + 2.97e0 END + 1e-9, {PLACES}) AS calibrated FROM ev""")

add("f13_rel_diff",
    lambda s, d: t.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(values.rel_diff(
        "l_tax", "l_discount") + 1e-9, PLACES).alias("diff")),
    f"SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount <> 0 THEN abs(l_tax - l_discount) / abs(l_discount) END + 1e-9, {PLACES}) AS diff FROM lineitem")

add("f14_round_coord", lambda s, d: t.events(s, d).select("event_id", geo.round_coord("lon").alias("lon")),
    "SELECT event_id, round_even(lon, 4) AS lon FROM ev")

add("f15_sensor_key", lambda s, d: t.events(s, d).select("event_id", geo.sensor_key().alias("key")),
    "SELECT event_id, \"datasourceId\" || '||' || \"sourceId\" AS key FROM ev")

add("f17_type_rank",
    lambda s, d: _cells(s, d).select("date", "datasourceId", labels.type_rank().alias("rank")),
    'SELECT date, "datasourceId", CAST(5 AS INTEGER) AS rank FROM cells3', cells3=_CELLS3)

add("f18_qc_column_for",
    lambda s, d: t.wide(s, d).groupBy(values.quoted(values.qc_column_for(t.VALUE)).alias("qc")).agg(F.count("*").alias("n")),
    "SELECT qc, count(*) AS n FROM ev GROUP BY qc")

add("f19_mask_text",
    lambda s, d: t.table(s, d, "documents").select("doc_id", values.mask_text("text").alias("masked")),
    "SELECT doc_id, CASE WHEN length(text) > 20 THEN substr(text, 1, 20) || '...' ELSE text END AS masked FROM documents")

# --- sources and sinks: written to the shared folder and read back ------------------------

_WIDE_SCHEMA = T.StructType([
    *MEASUREMENT_IDS.fields, T.StructField("endOfPeriod", T.TimestampType()),
    T.StructField(t.VALUE, T.DoubleType()), T.StructField(t.ASSESSMENT, T.StringType()),
    T.StructField("event_id", T.LongType())])


def _landed_csv(s, d, **options) -> str:
    """The events as hourly sensor files with a NaN and an index column."""
    path = scratch_path(s, "wide-csv")
    value = F.when(F.col(f"`{t.ASSESSMENT}`") == "invalid", F.lit(float("nan"))).otherwise(values.quoted(t.VALUE))
    (t.wide(s, d).withColumn(t.VALUE, value).withColumn("Unnamed: 0", F.col("event_id"))
     .select("Unnamed: 0", *[values.quoted(f.name) for f in _WIDE_SCHEMA.fields])
     .write.options(header=True, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", **options).csv(path))
    return path


_READ_SQL = f"""SELECT {KEYS}, 'CLOUD' AS "sourceType", round(lat, 6) AS lat, strftime("endOfPeriod", '{_SEC}') AS at,
    CASE WHEN qc IS DISTINCT FROM 'invalid' THEN value END AS value, qc, event_id FROM ev"""


def _read_back(df: DataFrame) -> DataFrame:
    return df.select(*SENSOR, "sourceType", F.round("locationLatitude", 6).alias("lat"), _text("endOfPeriod").alias("at"),
                     values.quoted(t.VALUE).alias("value"), values.quoted(t.ASSESSMENT).alias("qc"), "event_id")


add("s1_read_measurements_wide",
    lambda s, d: _read_back(measurements.read_measurements_wide(s, _landed_csv(s, d), _WIDE_SCHEMA)), _READ_SQL)


def _parts(s, d) -> DataFrame:
    """The events as a report of two parts: one gzipped, one with another column order and one more column."""
    other = scratch_path(s, "part")
    (t.wide(s, d).select(values.quoted(t.VALUE), "event_id", "sourceId", "datasourceId", F.lit("x").alias("extra"))
     .write.option("header", True).csv(other))
    parts = measurements.read_report_parts(s, [_landed_csv(s, d, compression="gzip"), other], _WIDE_SCHEMA)
    return parts.select(*SENSOR, "event_id", values.quoted(t.VALUE).alias("value"), "extra")


add("s2_read_report_parts", _parts,
    f"SELECT {KEYS}, event_id, CASE WHEN qc IS DISTINCT FROM 'invalid' THEN value END AS value, NULL AS extra FROM ev "
    f"UNION ALL SELECT {KEYS}, event_id, value, 'x' FROM ev")


def _responses(s, d) -> str:
    """One JSON response per day of events, with locations only where the day has errors."""
    path = scratch_path(s, "responses")
    rows = t.long_rows(s, d).withColumn("day", F.substring("time", 1, 10))
    row = F.struct("datasourceId", "time", "metric", "value", F.col("value").alias("raw"), F.lit("ok").alias("status"))
    place = F.when(F.col("metric") == FEATURE_METRICS[1], F.struct(
        "datasourceId", F.lit(41.5).alias("lat"), F.lit(-87.5).alias("lon")))
    (rows.groupBy("day").agg(F.collect_list(row).alias("data"), F.collect_set(place).alias("locations"))
     .select(F.create_map(F.lit("day"), F.col("day")).alias("request"), "data",
             F.when(F.size("locations") > 0, F.col("locations")).alias("locations"))
     .write.json(path))
    return path


add("s3_read_measurements_long", lambda s, d: measurements.read_measurements_long(s, _responses(s, d), one_per_file=False)[0].drop("raw"),
    'SELECT "datasourceId", time, metric, value, \'ok\' AS status FROM lo')

add("s3_read_locations_long", lambda s, d: measurements.read_measurements_long(s, _responses(s, d), one_per_file=False)[1],
    f"SELECT \"datasourceId\", 41.5e0 AS lat, -87.5e0 AS lon FROM (SELECT DISTINCT \"datasourceId\", substr(time, 1, 10) FROM lo "
    f"WHERE metric = '{FEATURE_METRICS[1]}')")


def _dataset(s, d, codec: str = "zstd") -> str:
    path = scratch_path(s, "dataset")
    sinks.write_dataset(_cells(s, d), path, codec)
    return path


_CELLS_SQL = f"SELECT * REPLACE (round(value + 1e-9, {PLACES}) AS value) FROM cells3"

add("s4_read_dataset_or_empty",
    lambda s, d: rounded(measurements.read_dataset_or_empty(s, _dataset(s, d), CELLS).unionByName(
        measurements.read_dataset_or_empty(s, scratch_path(s, "absent"), CELLS)), "value"), _CELLS_SQL, cells3=_CELLS3)

add("s5_write_dataset", lambda s, d: rounded(s.read.parquet(_dataset(s, d, "snappy")), "value"), _CELLS_SQL, cells3=_CELLS3)


def _summaries(s, d) -> DataFrame:
    """All period types written in each format; how many rows every copy holds per type."""
    levels = rollup.rollup_days(t.daily(s, d), {"week": 5, "month": 21, "season": 60, "year": 250})
    found = None
    for fmt in (*sinks.SUMMARY_FORMATS, "xlsx"):
        path = scratch_path(s, f"summaries-{fmt}")
        if not sinks.write_summaries(levels, path, fmt):
            continue
        reader = s.read.option("header", True) if fmt == "csv" else s.read
        copy = reader.format(fmt).load(path).groupBy("type").agg(
            F.count("*").alias("n"), F.count_if(F.col("is_valid").cast("boolean")).alias("valid")).withColumn("fmt", F.lit(fmt))
        found = copy if found is None else found.unionByName(copy)
    return found


add("s6_write_summaries", _summaries,
    "SELECT f.fmt, type, count(*) AS n, count(*) FILTER (is_valid) AS valid FROM levels, (VALUES ('csv'), ('parquet'), ('json')) AS f(fmt) GROUP BY ALL",
    levels=" UNION ALL ".join(
        f"SELECT {KEYS}, '{x}' AS type, {sql_label(x, 'day')} AS date, count(*) > {n} AS is_valid FROM da GROUP BY ALL"
        for x, n in (("week", 5), ("month", 21), ("season", 60), ("year", 250))))


def _records(s, d) -> DataFrame:
    """Supplier rows as JSON records, a CSV of them converted to JSON, both read back as text."""
    rows = t.table(s, d, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") > 12, F.col("s_name")).alias("s_name"),
        (F.col("s_suppkey") * F.lit(2).cast("decimal(4,1)") / 4).alias("half"))
    first, csv, second = (scratch_path(s, x) for x in ("records", "records-csv", "converted"))
    sinks.write_json_records(rows, first)
    rows.write.option("header", True).csv(csv)
    sinks.csv_to_json(s, csv, second)
    parsed = s.read.text(first).select(F.from_json("value", "s_suppkey bigint, s_name string, half double").alias("r"), "value")
    return parsed.select("r.*", F.col("value").contains('"s_name":').alias("spelled")).join(
        s.read.json(second).select(F.col("s_suppkey").cast("bigint"), F.col("s_name").alias("again")), "s_suppkey")


add("s7_write_json_records", _records,
    """SELECT s_suppkey, CASE WHEN s_nationkey > 12 THEN s_name END AS s_name, s_suppkey / 2.0e0 AS half, true AS spelled,
        CASE WHEN s_nationkey > 12 THEN s_name END AS again FROM supplier""")


def _geojson(s, d) -> DataFrame:
    """Nations written as one GeoJSON layer of polygons and multipolygons, read back as edges."""
    edges = t.regions(s, d)
    corner = F.struct("ring", "seq", F.array("x1", "y1").alias("p"))
    rings = edges.groupBy("region_id", "ward").agg(F.array_sort(F.collect_list(corner)).alias("c"))

    def closed(n: int):
        pts = F.transform(F.filter("c", lambda x: x["ring"] == n), lambda x: x["p"])
        return F.concat(pts, F.slice(pts, 1, 1))

    polygon = F.to_json(F.array(closed(0), closed(1)))
    multi = F.col("region_id").cast("int") % 2 == 1
    feature = F.concat(F.lit('{"type":"Feature","properties":{"ward":"'), "ward", F.lit('","n":'), "region_id",
                       F.lit('},"geometry":{"type":"'), F.when(multi, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'),
                       F.when(multi, F.concat(F.lit("["), polygon, F.lit("]"))).otherwise(polygon), F.lit("}}"))
    path = scratch_path(s, "layer")
    (rings.agg(F.array_join(F.collect_list(feature), ",").alias("f"))
     .select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))
     .coalesce(1).write.text(path))
    back = boundaries.read_boundaries(s, path, "wards")
    return back.select("layer", "ward", "part", "ring", "seq", *[F.round(c, 9).alias(c) for c in ("x1", "y1", "x2", "y2")])


add("s8_read_boundaries", _geojson,
    "SELECT 'wards' AS layer, ward, 0 AS part, CASE WHEN half = 0.21e0 THEN 0 ELSE 1 END AS ring, seq, round(x1, 9) AS x1, "
    "round(y1, 9) AS y1, round(x2, 9) AS x2, round(y2, 9) AS y2 FROM rs",
    rs=t.CTES["re"].replace("SELECT n_nationkey, n_name AS ward,", "SELECT n_nationkey, n_name AS ward, half, seq,").replace(
        "VALUES " + ", ".join(f"({a}, {b}, {c}, {e}, {h}e0)" for _, _, a, b, c, e, h in t.RINGS),
        "VALUES " + ", ".join(f"({a}, {b}, {c}, {e}, {h}e0, {q})" for _, q, a, b, c, e, h in t.RINGS)).replace(
        "v(a, b, c, d, half)", "v(a, b, c, d, half, seq)"))


def _snapshot(s, d) -> DataFrame:
    root = scratch_path(s, "snapshots")
    sinks.snapshot_dataset(s, {"hours": _dataset(s, d)}, root, "2024-02-01T00-00-00")
    return rounded(s.read.parquet(f"{root}/*/hours").select("type", "date", "datasourceId", "value"), "value")


add("s10_snapshot_dataset", _snapshot, _CELLS_SQL, cells3=_CELLS3)


def _pole_csv(s, d) -> DataFrame:
    path = scratch_path(s, "poles")
    t.poles(s, d).withColumn("Remark", F.lit("kept out")).write.option("header", True).csv(path)
    return boundaries.read_candidates(s, path)


add("s11_read_candidates", _pole_csv,
    'SELECT sensor AS "sensorID", candidate AS "Candidate", CAST(area AS INTEGER) AS "ComArea", CAST(ward AS INTEGER) AS "Ward", '
    'CAST(zip AS INTEGER) AS "Zip", fid AS "FEATURE_ID", addr AS "Address", lat AS "Latitude", lon AS "Longitude", ord AS _ord FROM po')


def _offsets_json(s, d) -> DataFrame:
    path = scratch_path(s, "offsets")
    rows = _cells(s, d).select("type", "date").unionByName(
        rollup.rollup_days(t.daily(s, d), {"month": 21, "year": 250}).select("type", "date")).distinct()
    sinks.write_type_offsets(dataset.type_offsets(rows), path)
    return s.read.json(path)


add("s12_write_type_offsets", _offsets_json,
    """SELECT type, CAST(CASE type WHEN 'month' THEN h WHEN 'year' THEN h + m ELSE 0 END AS BIGINT) AS first_row FROM
        (VALUES ('hour'), ('day'), ('week'), ('month'), ('season'), ('year')) AS x(type),
        (SELECT count(DISTINCT date) AS h FROM cells3), (SELECT count(DISTINCT strftime(day, '%Y-%m')) AS m FROM da)""", cells3=_CELLS3)

# --- streams -----------------------------------------------------------------------------

_EVENT_STREAM = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("datasourceId", T.StringType()),
    T.StructField("sourceId", T.StringType()), T.StructField("endOfPeriod", T.TimestampType()),
    T.StructField("value", T.DoubleType())])


def _landing(s, d) -> str:
    """The events as files landing in time order, some hours apart from each other."""
    path = scratch_path(s, "landing")
    (t.events(s, d).select(*_EVENT_STREAM.names).repartitionByRange(6, "endOfPeriod").sortWithinPartitions("endOfPeriod")
     .write.parquet(path))
    return path


def _streamed(s, d) -> DataFrame:
    out, checkpoint = scratch_path(s, "streamed"), scratch_path(s, "streamed-state")
    rows = ingest.stream_measurements(s, _landing(s, d), _EVENT_STREAM, "parquet", files_per_batch=4)
    for _ in range(2):  # the second run finds nothing new
        ingest.run_available(rows, out, checkpoint)
    return s.read.parquet(out).select("event_id", "datasourceId", "sourceId", "value")


add("t1_stream_measurements", _streamed, f"SELECT event_id, {KEYS}, value FROM ev")


def _hours_stream(s, d, per_batch: int | None = None) -> DataFrame:
    """Lateness covers the whole table: landed files carry no promise about their order."""
    rows = ingest.stream_measurements(s, _landing(s, d), _EVENT_STREAM, "parquet", per_batch)
    return ingest.stream_hourly(rows, "endOfPeriod", "value", lateness="60 days")


def _streamed_hours(s, d) -> DataFrame:
    out, checkpoint = scratch_path(s, "hours"), scratch_path(s, "hours-state")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (_hours_stream(s, d, 3).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
     .foreachBatch(keep).trigger(availableNow=True).start().awaitTermination())
    last = F.max(F.struct("batch", "n_valid", "metric", "is_valid")).alias("r")
    return s.read.parquet(out).groupBy(*SENSOR, "hour").agg(last).select(
        *SENSOR, labels.hour_label("hour").alias("date"), "r.n_valid", near("r.metric").alias("metric"), "r.is_valid")


add("t2_stream_hourly", _streamed_hours,
    f"SELECT {KEYS}, {sql_hour_label('hour')} AS date, n_valid, round(metric + 1e-9, {PLACES}) AS metric, true AS is_valid FROM hours3")


def _streamed_store(s, d) -> DataFrame:
    target, checkpoint = scratch_path(s, "stream-store"), scratch_path(s, "stream-store-state")
    upsert.stream_upsert(_hours_stream(s, d), target, checkpoint).awaitTermination()
    return rounded(store.read_store(s, target).filter("type = 'hour'").drop("bucket"), "value")


add("t3_stream_upsert", _streamed_store, _CELLS_SQL, cells3=_CELLS3)

