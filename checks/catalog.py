"""Every registered query with the SQL that must give the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import sql_haversine, sql_hour_label, sql_label, with_views
from smogline.functions import geo, labels, values
from smogline.operators import dataset, impute, quality, rollup, series, spatial
from smogline.plans import cleaners, locations, metric_run
from smogline.schema import MIN_PARTS, SENSOR, MetricSpec
from smogline.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}

PLACES = 7
KEYS = '"datasourceId", "sourceId"'


def add(name: str, fn, sql: str | None = None, **extra: str) -> None:
    QUERIES[name] = fn
    if sql is not None:
        SQL[name] = with_views(sql, extra)


def near(c: str) -> F.Column:
    """Rounded, because sums run in another order in SQL. The small shift keeps exact halves,
    which means of few values often are, away from the rounding border; the SQL has it too."""
    return F.round(F.col(c) + 1e-9, PLACES)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: near(f"`{c}`") for c in cols})


# --- filters and projections -------------------------------------------------------------

SPEC = MetricSpec("air", t.VALUE, qc=True)
START, END = datetime(2024, 1, 8), datetime(2024, 1, 22, 12)

add("p1_select_metrics",
    lambda s, d: quality.select_metrics(t.wide(s, d), "only :pm25", {"pm25": ["pm2_5ConcMass1*"]}),
    f'SELECT "datasourceId", "sourceId", \'CLOUD\' AS "sourceType", lat AS "locationLatitude", '
    f'lon AS "locationLongitude", "endOfPeriod", \'hour\' AS "outputFrequency", value AS "{t.VALUE}", '
    f'qc AS "{t.ASSESSMENT}", event_id FROM ev')

add("p2_filter_time",
    lambda s, d: quality.filter_time(t.table(s, d, "events"), "ts", START, END).select("event_id", "value"),
    "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22 12:00:00'")

add("p3_drop_invalid_qc",
    lambda s, d: quality.drop_invalid_qc(t.wide(s, d), SPEC).select("event_id", F.col(f"`{t.ASSESSMENT}`").alias("qc")),
    "SELECT event_id, qc FROM ev WHERE qc IS DISTINCT FROM 'invalid'")

add("p4_filter_ranges",
    lambda s, d: quality.filter_ranges(
        t.grid(s, d).withColumn("low", F.col("value") - 103).withColumn("high", F.col("value") + 390),
        {"low": (0.0, 5.0), "high": (0.0, 500.0)}).select("datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at")),
    "SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at FROM gr WHERE (value IS NULL OR value - 103 BETWEEN 0 AND 5) "
    "AND (value IS NULL OR value + 390 BETWEEN 0 AND 500)")

_FRAME = 'OVER (PARTITION BY "datasourceId" ORDER BY time ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)'

add("p5_drop_flatline",
    lambda s, d: series.drop_flatline(t.grid(s, d, flat=True), "time", "value").select(
        "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"), near("value").alias("value")),
    f"""SELECT "datasourceId", strftime(time, '%Y-%m-%d %H') AS at, round(value + 1e-9, {PLACES}) AS value FROM
        (SELECT *, count(value) {_FRAME} AS n, min(value) {_FRAME} AS lo, max(value) {_FRAME} AS hi FROM grf)
        WHERE NOT (n >= 2 AND lo = hi) OR lo IS NULL""")

add("p6_rename_columns",
    lambda s, d: quality.rename_columns(t.table(s, d, "supplier"), {"s_name": "name", "absent": "name2"}),
    "SELECT s_suppkey, s_name AS name, s_nationkey, s_acctbal FROM supplier")

add("p7_project_locations",
    lambda s, d: locations.project_locations(t.wide(s, d), ["event_id"]),
    f"""SELECT {KEYS}, 'CLOUD' AS "sourceType", round_even(lat, 4) AS "locationLatitude",
        round_even(lon, 4) AS "locationLongitude" FROM ev
        QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY event_id) = 1""")


def _levels_sql(level: str, source: str = "da", limit: int | None = None) -> str:
    at = {"day": "hour", "hour": "hour"}.get(level, "day")
    return (f"SELECT {KEYS}, {sql_label(level, at)} AS date, '{level}' AS type, avg(metric) AS metric, "
            f"count(*) AS n_valid, count(*) > {MIN_PARTS[level] if limit is None else limit} AS is_valid "
            f"FROM {source} GROUP BY ALL")


_ALL_LEVELS = " UNION ALL ".join(_levels_sql(x) for x in ("week", "month", "season", "year"))
_LIMITS = {k: MIN_PARTS[k] for k in ("week", "month", "season", "year")}

add("p8_filter_type",
    lambda s, d: rounded(dataset.filter_type(rollup.rollup_days(t.daily(s, d), _LIMITS), "month"), "metric"),
    f"SELECT * REPLACE (round(metric + 1e-9, {PLACES}) AS metric) FROM ({_levels_sql('month')})")

add("p9_keep_valid",
    lambda s, d: quality.keep_valid(quality.flag_valid(
        rollup.rollup_hour(t.hourly(s, d), "endOfPeriod", "value"), F.col("n_valid") >= 3))
    .select(*SENSOR, labels.hour_label("hour").alias("date"), "n_valid"),
    f"SELECT {KEYS}, {sql_hour_label('hour')} AS date, n_valid FROM hours WHERE n_valid >= 3")

add("p10_metric_as",
    lambda s, d: rounded(quality.metric_as(rollup.rollup_year(t.daily(s, d)), "quantity"), "quantity"),
    f"SELECT * EXCLUDE (metric), round(metric + 1e-9, {PLACES}) AS quantity FROM ({_levels_sql('year')})")

add("p11_drop_missing",
    lambda s, d: rounded(quality.drop_missing(t.grid(s, d), "value").select(
        "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"), "value", "impute_flag"), "value"),
    f"SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at, round(value + 1e-9, {PLACES}) AS value, "
    "'drop_na_lt5' AS impute_flag FROM gr WHERE value IS NOT NULL")

# --- rollups -----------------------------------------------------------------------------

add("a1_rollup_hour",
    lambda s, d: rounded(rollup.label_hours(rollup.rollup_hour(t.events(s, d), "endOfPeriod", "value", 2)), "metric"),
    f"SELECT {KEYS}, {sql_hour_label('hour')} AS date, 'hour' AS type, round(metric + 1e-9, {PLACES}) AS metric, n_valid, "
    "n_valid >= 2 AS is_valid FROM hours3")

add("a2_rollup_day",
    lambda s, d: rounded(rollup.label_days(rollup.rollup_day(
        rollup.rollup_hour(t.hourly(s, d), "endOfPeriod", "value"))), "metric"),
    f"SELECT {KEYS}, strftime(day, '%Y-%m-%d') AS date, 'day' AS type, round(metric + 1e-9, {PLACES}) AS metric, n_valid, "
    "n_valid > 20 AS is_valid FROM days")

for _level, _fn in (("week", rollup.rollup_week), ("month", rollup.rollup_month),
                    ("season", rollup.rollup_season), ("year", rollup.rollup_year)):
    add({"week": "a3", "month": "a4", "season": "a5", "year": "a6"}[_level] + f"_rollup_{_level}",
        lambda s, d, fn=_fn: rounded(fn(t.daily(s, d)), "metric"),
        f"SELECT * REPLACE (round(metric + 1e-9, {PLACES}) AS metric) FROM ({_levels_sql(_level)})")

_VALID_DAYS = "SELECT * FROM days WHERE n_valid > 20"
_CHAIN = (f"SELECT {KEYS}, {sql_hour_label('hour')} AS date, 'hour' AS type, metric, n_valid, n_valid >= 1 AS is_valid FROM hours "
          f"UNION ALL SELECT {KEYS}, strftime(day, '%Y-%m-%d'), 'day', metric, n_valid, n_valid > 20 FROM days UNION ALL "
          + " UNION ALL ".join(_levels_sql(x, "vdays") for x in ("week", "month", "season", "year")))

add("a7_rollup_all",
    lambda s, d: rounded(rollup.rollup_all(t.hourly(s, d), "endOfPeriod", "value"), "metric"),
    f"SELECT * REPLACE (round(metric + 1e-9, {PLACES}) AS metric) FROM chain WHERE is_valid", chain=_CHAIN, vdays=_VALID_DAYS)

add("a8_completeness",
    lambda s, d: rounded(quality.completeness(rollup.rollup_hour(t.events(s, d), "endOfPeriod", "value", 2)), "pct_valid"),
    f"SELECT {KEYS}, count(*) AS hours_total, count(*) FILTER (n_valid >= 2) AS hours_valid, "
    f"round(100.0e0 * count(*) FILTER (n_valid >= 2) / greatest(count(*), 1) + 1e-9, {PLACES}) AS pct_valid FROM hours3 GROUP BY ALL")

add("a9_missing_rate",
    lambda s, d: rounded(quality.missing_rate(t.grid(s, d), "value"), "missing_rate"),
    f"SELECT round(avg(CASE WHEN value IS NULL THEN 1.0e0 ELSE 0.0e0 END) + 1e-9, {PLACES}) AS missing_rate FROM gr")

add("a13_distinct_sensors",
    lambda s, d: spatial.distinct_sensors(t.wide(s, d).withColumns(
        {"locationLatitude": F.round("locationLatitude", 1), "locationLongitude": F.round("locationLongitude", 0)})),
    f"SELECT DISTINCT {KEYS}, round(lat, 1) AS lat, round(lon, 0) AS lon, \"datasourceId\" || '||' || \"sourceId\" AS key FROM ev")

add("a16_validity_summary",
    lambda s, d: quality.validity_summary(rollup.rollup_all(t.hourly(s, d), "endOfPeriod", "value", only_valid=False)
                                          .unionByName(rollup.rollup_days(t.daily(s, d), _LIMITS))),
    "SELECT type, count(*) AS rows_all, count(*) FILTER (is_valid) AS rows_valid FROM "
    f"(SELECT * FROM chain UNION ALL {_ALL_LEVELS}) GROUP BY ALL", chain=_CHAIN, vdays=_VALID_DAYS)

add("u1_union_levels",
    lambda s, d: rounded(rollup.union_levels({
        "year": rollup.rollup_year(t.daily(s, d)), "month": rollup.rollup_month(t.daily(s, d)),
        "day": t.daily(s, d).withColumn("date", F.to_date("day")).drop("day", "n_valid")}), "metric")
    .select(*SENSOR, "date", "type", "metric", "n_valid", "is_valid"),
    f"SELECT * REPLACE (round(metric + 1e-9, {PLACES}) AS metric) FROM ({_levels_sql('year')} UNION ALL {_levels_sql('month')} UNION ALL "
    f"SELECT {KEYS}, strftime(day, '%Y-%m-%d'), 'day', metric, NULL, true FROM da)")

# --- matrix, upserts, order --------------------------------------------------------------

_CELLS3 = (f"SELECT 'hour' AS type, {sql_hour_label('hour')} AS date, \"datasourceId\", "
           "arg_max(metric, \"sourceId\") AS value FROM hours3 WHERE metric IS NOT NULL GROUP BY ALL")


def _cells(s, d) -> DataFrame:
    return dataset.sensor_cells(rollup.label_hours(rollup.rollup_hour(t.events(s, d), "endOfPeriod", "value")))


def _restated(s, d) -> DataFrame:
    """The hours half a month later, doubled, without a value where one reading was all."""
    hours = rollup.rollup_hour(t.events(s, d).withColumn("endOfPeriod", F.col("endOfPeriod") + F.expr("interval 15 days")),
                               "endOfPeriod", "value")
    cells = rollup.label_hours(hours.withColumn("metric", F.col("metric") * 2))
    return cells.groupBy("type", "date", "datasourceId").agg(
        F.max_by(F.when(F.col("n_valid") > 1, F.col("metric")), "sourceId").alias("value"))


_RESTATED = (f"SELECT 'hour' AS type, {sql_hour_label('h')} AS date, \"datasourceId\", "
             "CASE WHEN arg_max(n_valid, \"sourceId\") > 1 THEN arg_max(metric, \"sourceId\") * 2 END AS value FROM "
             "(SELECT *, hour + INTERVAL 15 DAY AS h FROM hours3) GROUP BY ALL")
_UPSERTED = ("SELECT coalesce(n.type, c.type) AS type, coalesce(n.date, c.date) AS date, "
             "coalesce(n.\"datasourceId\", c.\"datasourceId\") AS \"datasourceId\", coalesce(n.value, c.value) AS value "
             "FROM restated n FULL JOIN cells3 c ON n.type = c.type AND n.date = c.date AND n.\"datasourceId\" = c.\"datasourceId\"")
_VIEWS = {"cells3": _CELLS3, "restated": _RESTATED, "upserted": _UPSERTED}
TYPES = ["click", "error", "purchase", "signup", "view"]

add("a11_pivot_sensors",
    lambda s, d: rounded(dataset.pivot_sensors(rollup.label_hours(
        rollup.rollup_hour(t.events(s, d), "endOfPeriod", "value")), sensors=TYPES), *TYPES),
    "SELECT type, date, " + ", ".join(
        f"round(max(value) FILTER (\"datasourceId\" = '{x}') + 1e-9, {PLACES}) AS {x}" for x in TYPES)
    + " FROM cells3 GROUP BY type, date", **_VIEWS)

add("a11_unpivot_sensors",
    lambda s, d: rounded(dataset.unpivot_sensors(dataset.pivot_cells(_cells(s, d))), "value"),
    f"SELECT * REPLACE (round(value + 1e-9, {PLACES}) AS value) FROM cells3", **_VIEWS)

add("j3_upsert_measurements",
    lambda s, d: rounded(dataset.upsert_measurements(_cells(s, d), _restated(s, d)), "value"),
    f"SELECT * REPLACE (round(value + 1e-9, {PLACES}) AS value) FROM upserted", **_VIEWS)

add("u2_combine_rows",
    lambda s, d: dataset.combine_rows(
        t.table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"),
        t.table(s, d, "lineitem").select("l_linestatus", "l_linenumber", F.col("l_quantity").alias("q"))),
    "SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem UNION BY NAME "
    "SELECT l_linestatus, l_linenumber, l_quantity AS q FROM lineitem")

add("u3_concat_parts",
    lambda s, d: t.events(s, d).select("event_id", "value").unionByName(
        t.events(s, d).select("qc", "event_id"), allowMissingColumns=True),
    "SELECT event_id, value FROM ev UNION ALL BY NAME SELECT qc, event_id FROM ev")


def _ordered(s, d) -> DataFrame:
    """The rows of the measurement matrix, latest first."""
    rows = rollup.rollup_all(t.hourly(s, d), "endOfPeriod", "value").select("type", "date").distinct()
    return dataset.order_latest_first(rows)


_MATRIX_ROWS = "SELECT DISTINCT type, date FROM chain WHERE is_valid"

add("o1_order_latest_first", _ordered, "SELECT type, date FROM mrows ORDER BY " + t.SQL_RANK + " DESC, date DESC",
    chain=_CHAIN, vdays=_VALID_DAYS, mrows=_MATRIX_ROWS)

add("o2_order_sensors", lambda s, d: dataset.order_sensors(t.daily(s, d).select(*SENSOR).distinct()),
    f"SELECT DISTINCT {KEYS} FROM da ORDER BY ALL")

add("o4_preview",
    lambda s, d: dataset.preview(quality.completeness(rollup.rollup_hour(t.events(s, d), "endOfPeriod", "value"))
                                 .drop("pct_valid"), SENSOR),
    f"SELECT {KEYS}, count(*) AS hours_total, count(*) AS hours_valid FROM hours3 GROUP BY ALL ORDER BY {KEYS} LIMIT 6")

add("a12_type_offsets",
    lambda s, d: dataset.type_offsets(
        rollup.rollup_all(t.hourly(s, d), "endOfPeriod", "value").select("type", "date").distinct()),
    "SELECT t.type, CAST(CASE WHEN count(m.date) FILTER (m.type = t.type) = 0 THEN 0 ELSE "
    "count(m.date) FILTER (m.r > t.r) END AS BIGINT) AS first_row FROM "
    "(VALUES ('year', 0), ('season', 1), ('month', 2), ('week', 3), ('day', 4), ('hour', 5)) AS t(type, r), "
    f"(SELECT *, {t.SQL_RANK} AS r FROM mrows) m GROUP BY t.type",
    chain=_CHAIN, vdays=_VALID_DAYS, mrows=_MATRIX_ROWS)

add("w6_first_per_key",
    lambda s, d: dataset.first_per_key(t.table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"),
                                       ["o_custkey"], ["o_totalprice", "o_orderkey"]),
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1")

# --- rows of a series --------------------------------------------------------------------

add("w1_rolling_sd",
    lambda s, d: series.rolling_sd(series.place_rows(t.grid(s, d, flat=True), "time"), "value").df.select(
        "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"), F.round("rolling_sd", 5).alias("sd")),
    f"SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at, round(stddev_samp(value) {_FRAME}, 5) AS sd FROM grf")

_BY_TIME = 'OVER (PARTITION BY "datasourceId" ORDER BY time)'
_GAPS = f"""SELECT *, row_number() {_BY_TIME} - 1 AS pos, lag(value) {_BY_TIME} AS p, lead(value) {_BY_TIME} AS n,
    sum(value) {_FRAME} AS s, count(value) {_FRAME} AS c FROM gr"""
_FILL = "CASE WHEN value IS NULL AND abs((p + n) / 2 - s / c) / abs(s / c) <= 0.05e0 THEN (p + n) / 2 ELSE value END"


def _filled(s, d, mode: str, grid=t.grid) -> DataFrame:
    filled = impute.fill_single_gaps(series.place_rows(grid(s, d), "time"), "value", mode=mode).rows()
    return filled.select("datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"),
                         near("value").alias("value"))


add("w2_fill_single_gaps_window", lambda s, d: _filled(s, d, "window"),
    f"SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at, round({_FILL} + 1e-9, {PLACES}) AS value FROM gaps", gaps=_GAPS)

# The exact filling, row by row: "last5" holds the last five values after filling.
_AHEAD = 'OVER (PARTITION BY "datasourceId" ORDER BY time ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)'
_STEPS = f"""SELECT *, row_number() {_BY_TIME} AS i, lead(value) {_BY_TIME} AS n, coalesce(sum(value) {_AHEAD}, 0) AS fs,
    count(value) {_AHEAD} AS fc FROM gr"""
_NEW = """CASE WHEN g.value IS NOT NULL THEN g.value WHEN w.last5[-1] IS NOT NULL AND g.n IS NOT NULL AND
    abs((w.last5[-1] + g.n) / 2 - (coalesce(list_sum(w.last5), 0) + g.fs) / (list_count(w.last5) + g.fc))
    / abs((coalesce(list_sum(w.last5), 0) + g.fs) / (list_count(w.last5) + g.fc)) <= 0.05e0
    THEN (w.last5[-1] + g.n) / 2 END"""
_WALK = f"""SELECT "datasourceId", i, value AS v, [value] AS last5 FROM steps WHERE i = 1 UNION ALL
    SELECT "datasourceId", i, v, list_slice(list_append(last5, v), -5, -1) FROM
    (SELECT g."datasourceId", g.i, w.last5, {_NEW} AS v FROM walked w JOIN steps g
     ON g."datasourceId" = w."datasourceId" AND g.i = w.i + 1)"""
_EXACT_VIEWS = {"steps": _STEPS, "walked": _WALK,
                "exact": """SELECT g.* EXCLUDE (value, i, n, fs, fc), w.v AS value FROM steps g JOIN walked w USING ("datasourceId", i)"""}

add("w2_fill_single_gaps", lambda s, d: _filled(s, d, "exact"),
    f"SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at, round(value + 1e-9, {PLACES}) AS value FROM exact", **_EXACT_VIEWS)


def _runs_sql(source: str) -> str:
    return f"""SELECT "datasourceId", min(pos) AS start, max(pos) AS stop, count(*) AS length,
        arg_min(p, pos) AS before, arg_max(n, pos) AS after FROM
        (SELECT *, pos - row_number() {_BY_TIME} AS island FROM
         (SELECT "datasourceId", time, value, row_number() {_BY_TIME} - 1 AS pos, lag(value) {_BY_TIME} AS p,
          lead(value) {_BY_TIME} AS n FROM {source}) WHERE value IS NULL) GROUP BY "datasourceId", island"""


add("w3_null_runs",
    lambda s, d: rounded(series.null_runs(series.place_rows(t.grid(s, d), "time"), "value"), "edge_before", "edge_after")
    .select("datasourceId", "start", "stop", "length", "edge_before", "edge_after"),
    f"SELECT \"datasourceId\", start, stop, length, round(before + 1e-9, {PLACES}) AS edge_before, round(after + 1e-9, {PLACES}) AS edge_after FROM ({_runs_sql('gr')})")

# Nearest sensors, brute force.
_DIST = sql_haversine("a.lat", "a.lon", "b.lat", "b.lon")


def _near_sql(sensors: str, k: int) -> str:
    return (f"SELECT a.key AS key1, b.key AS key2, {_DIST} AS dist_km, row_number() OVER (PARTITION BY a.key ORDER BY {_DIST}, b.key) AS rn "
            f"FROM {sensors} a JOIN {sensors} b ON a.key <> b.key QUALIFY rn <= {k}")


_SENSORS = "SELECT DISTINCT \"datasourceId\" || '||' || \"sourceId\" AS key, lat, lon FROM gr"

add("w5_nearest_neighbors",
    lambda s, d: spatial.nearest_neighbors(t.places(s, d), 3).withColumn("dist_km", F.round("dist_km", 6)),
    f"SELECT * REPLACE (round(dist_km, 6) AS dist_km) FROM ({_near_sql('pl', 3)})")

add("a17_neighbor_lists",
    lambda s, d: spatial.neighbor_lists(spatial.nearest_neighbors(t.places(s, d), 5)).select(
        "key1", F.array_join("neighbors", ",").alias("neighbors")),
    f"SELECT key1, string_agg(key2, ',' ORDER BY rn) AS neighbors FROM ({_near_sql('pl', 5)}) GROUP BY key1")

_MEANS_SQL = """SELECT r."datasourceId", r.time, avg(v.value) AS nb_mean FROM gr r
    JOIN near n ON n.key1 = r."datasourceId" || '||' || r."sourceId"
    JOIN {values} v ON v."datasourceId" || '||' || v."sourceId" = n.key2 AND v.time = r.time AND v.value IS NOT NULL
    WHERE r.value IS NULL GROUP BY ALL"""


def _neighbors(df: DataFrame, k: int = 3) -> DataFrame:
    return spatial.nearest_neighbors(spatial.distinct_sensors(df), k)


def _neighbor_means(s, d) -> DataFrame:
    rows = t.grid(s, d).withColumn("key", geo.sensor_key())
    found = impute.neighbor_means(rows.filter("value is null"), _neighbors(rows), rows, "time", "value",
                                  ["datasourceId", "time"])
    return found.select("datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"),
                        near("nb_mean").alias("nb_mean"))


add("j6_neighbor_means", _neighbor_means,
    f"SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at, round(nb_mean + 1e-9, {PLACES}) AS nb_mean FROM "
    f"({_MEANS_SQL.format(values='gr')})", near=_near_sql("sensors", 3), sensors=_SENSORS)


def _chunks_sql(source: str) -> dict[str, str]:
    """Views that fill runs of two or more in ``source``."""
    return {
        "near": _near_sql("sensors", 3), "sensors": _SENSORS, "runs": _runs_sql(source),
        "nbm": f"""SELECT r."datasourceId", r.pos, avg(v.value) AS nb FROM numbered r
            JOIN near n ON n.key1 = r."datasourceId" || '||' || r."sourceId"
            JOIN {source} v ON v."datasourceId" || '||' || v."sourceId" = n.key2 AND v.time = r.time
            WHERE r.value IS NULL GROUP BY ALL""",
        "numbered": f"SELECT *, row_number() {_BY_TIME} - 1 AS pos FROM {source}",
        "good": """SELECT r."datasourceId", start, stop FROM runs r JOIN nbm m ON m."datasourceId" = r."datasourceId"
            AND m.pos BETWEEN start AND stop WHERE length >= 2 GROUP BY r."datasourceId", start, stop, before, after
            HAVING abs(coalesce(before, after) - avg(nb)) / abs(avg(nb)) <= 0.05e0""",
        "chunked": """SELECT g.* EXCLUDE (value, pos), CASE WHEN g.value IS NULL AND k.start IS NOT NULL THEN m.nb ELSE g.value END AS value
            FROM numbered g LEFT JOIN good k ON k."datasourceId" = g."datasourceId" AND g.pos BETWEEN k.start AND k.stop
            LEFT JOIN nbm m ON m."datasourceId" = g."datasourceId" AND m.pos = g.pos""",
    }


def _chunk_filled(s, d, grid=t.grid) -> DataFrame:
    rows = grid(s, d)
    filled = impute.fill_gap_chunks(series.place_rows(rows, "time"), _neighbors(rows), "value").rows()
    return filled.select("datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"),
                         near("value").alias("value"))


add("w4_fill_gap_chunks", _chunk_filled,
    f"SELECT \"datasourceId\", strftime(time, '%Y-%m-%d %H') AS at, round(value + 1e-9, {PLACES}) AS value FROM chunked",
    **_chunks_sql("gr"))

# One statement for all three branches: the share of missing rows decides which one yields rows.
_IMPUTE_SQL = f"""SELECT "datasourceId", strftime(time, '%Y-%m-%d %H') AS at, round(value + 1e-9, {PLACES}) AS value, impute_flag FROM (
    SELECT "datasourceId", time, value, 'drop_na_lt5' AS impute_flag FROM gr WHERE value IS NOT NULL AND (SELECT r FROM rate) < 0.05e0
    UNION ALL SELECT "datasourceId", time, value, 'no_impute_ge20' FROM gr WHERE (SELECT r FROM rate) >= 0.2e0
    UNION ALL SELECT "datasourceId", time, value, 'impute_5to20' FROM chunked WHERE (SELECT r FROM rate) >= 0.05e0 AND (SELECT r FROM rate) < 0.2e0)"""
_RATE = {"rate": "SELECT avg(CASE WHEN value IS NULL THEN 1.0e0 ELSE 0.0e0 END) AS r FROM gr"}

def _imputed(s, d, grid=t.grid) -> DataFrame:
    return impute.qa_qc_impute(grid(s, d), "time", "value").select(
        "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"), near("value").alias("value"), "impute_flag")


add("x1_qa_qc_impute", _imputed,
    _IMPUTE_SQL, **_EXACT_VIEWS, **_chunks_sql("exact"), **_RATE)

add("a10_flag_counts",
    lambda s, d: quality.flag_counts(impute.qa_qc_impute(t.grid(s, d), "time", "value")),
    f"SELECT impute_flag, count(*) AS n FROM ({_IMPUTE_SQL}) GROUP BY impute_flag", **_EXACT_VIEWS, **_chunks_sql("exact"), **_RATE)

# --- whole cleaning runs -----------------------------------------------------------------


def _minutes(s, d, grid=None) -> DataFrame:
    """The grid as minute-sensor rows; humidity and temperature follow from the hour."""
    hour = F.hour("time")
    return (grid(s, d) if grid else t.grid(s, d, flat=True)).select(
        *SENSOR, F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"),
        "locationLatitude", "locationLongitude", F.col("value").alias("pm2_5ConcMassIndividual.raw"),
        (hour * F.lit(5.0) - 2).alias("relHumidInternalIndividual.raw"),
        (hour * F.lit(7.0) - 20).alias("temperatureInternalIndividual.raw"),
        F.when(hour == 13, "invalid").alias("pm2_5ConcMassIndividual.qcAssessment"))


def _prepared(s, d, grid=None) -> DataFrame:
    return cleaners.prepare_minute_pm25(quality.drop_invalid_qc(
        _minutes(s, d, grid), MetricSpec("m", "pm2_5ConcMassIndividual.value", qc="true"))).select(
            "datasourceId", F.date_format("time", "yyyy-MM-dd HH").alias("at"),
            near("`pm2_5ConcMassIndividual.raw`").alias("raw"),
            near("`pm2_5ConcMassIndividual.calibrated`").alias("calibrated"), "impute_flag")


_PREPARED_SQL = f"""SELECT "datasourceId", strftime(time, '%Y-%m-%d %H') AS at, round(value + 1e-9, {PLACES}) AS raw,
        round(CASE WHEN value < 343 THEN 0.524e0 * value - 0.0862e0 * (hour(time) * 5.0e0 - 2) + 5.75e0
                   WHEN value >= 343 THEN 0.46e0 * value + 0.000393e0 * value * value + 2.97e0 END + 1e-9, {PLACES}) AS calibrated,
        impute_flag FROM (
    SELECT "datasourceId", time, value, 'drop_na_lt5' AS impute_flag FROM lively WHERE value IS NOT NULL AND (SELECT r FROM rate) < 0.05e0
    UNION ALL SELECT "datasourceId", time, value, 'no_impute_ge20' FROM lively WHERE (SELECT r FROM rate) >= 0.2e0
    UNION ALL SELECT "datasourceId", time, value, 'impute_5to20' FROM chunked WHERE (SELECT r FROM rate) >= 0.05e0 AND (SELECT r FROM rate) < 0.2e0)"""
_PREPARED_VIEWS = dict(
    plausible="SELECT * FROM grf WHERE hour(time) <> 13 AND hour(time) * 5.0e0 - 2 BETWEEN 0 AND 100 AND hour(time) * 7.0e0 - 20 BETWEEN -20 AND 140",
    lively=f"""SELECT * EXCLUDE (cn, lo, hi) FROM (SELECT *, count(value) {_FRAME} AS cn, min(value) {_FRAME} AS lo,
        max(value) {_FRAME} AS hi FROM plausible) WHERE NOT (cn >= 2 AND lo = hi) OR lo IS NULL""",
    rate="SELECT avg(CASE WHEN value IS NULL THEN 1.0e0 ELSE 0.0e0 END) AS r FROM lively",
    steps=_STEPS.replace("FROM gr", "FROM lively"), walked=_WALK, exact=_EXACT_VIEWS["exact"], **_chunks_sql("exact"))

add("x2_prepare_minute_pm25", _prepared, _PREPARED_SQL, **_PREPARED_VIEWS)


def _minute_periods(s, d) -> DataFrame:
    spec = MetricSpec("mean_pm25", "pm2_5ConcMassIndividual.value", output_frequency="minute", qc=True, cleaner="minute_pm25")
    rows = t.events(s, d)
    hour = F.hour("endOfPeriod")
    minutes = rows.select(
        "datasourceId", F.upper("datasourceId").alias("sourceId"),
        F.date_format("endOfPeriod", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.lit(41.5).alias("locationLatitude"), F.lit(-87.5).alias("locationLongitude"),
        F.col("value").alias("pm2_5ConcMassIndividual.raw"), (hour * F.lit(5.0) - 2).alias("relHumidInternalIndividual.raw"),
        (hour * F.lit(7.0) - 20).alias("temperatureInternalIndividual.raw"),
        F.col("qc").alias("pm2_5ConcMassIndividual.qcAssessment"))
    return rounded(cleaners.clean(minutes, spec), "mean_pm25")


add("x2_clean_minute_pm25", _minute_periods,
    f"""SELECT * REPLACE (round(mean_pm25 + 1e-9, {PLACES}) AS mean_pm25) FROM (
        SELECT {KEYS}, {sql_hour_label('hour')} AS date, 'hour' AS type, metric AS mean_pm25, n_valid, true AS is_valid FROM mh
        UNION ALL SELECT {KEYS}, strftime(day, '%Y-%m-%d'), 'day', metric, n_valid, true FROM md
        UNION ALL SELECT * FROM ({' UNION ALL '.join(_levels_sql(x, 'md') for x in ('week', 'month', 'season', 'year'))}) WHERE is_valid)""",
    mh=f"""SELECT "datasourceId", "sourceId", date_trunc('hour', "endOfPeriod") AS hour, count(*) AS n_valid, avg(value) AS metric
        FROM ho WHERE qc IS DISTINCT FROM 'invalid' AND value BETWEEN 0 AND 500 AND hour("endOfPeriod") * 5.0e0 - 2 BETWEEN 0 AND 100
        AND hour("endOfPeriod") * 7.0e0 - 20 BETWEEN -20 AND 140 GROUP BY ALL HAVING count(*) >= 3""",
    md=f"SELECT {KEYS}, date_trunc('day', hour) AS day, count(*) AS n_valid, avg(metric) AS metric FROM mh GROUP BY ALL HAVING count(*) > 20")

_QC_CHAIN = _CHAIN.replace("FROM hours", "FROM qhours").replace("FROM days", "FROM qdays")
_QC_VIEWS = {
    "qhours": "SELECT * FROM hours WHERE \"datasourceId\" <> 'error'",
    "qdays": "SELECT * FROM days WHERE \"datasourceId\" <> 'error'",
    "vdays": "SELECT * FROM qdays WHERE n_valid > 20", "chain": _QC_CHAIN,
}

add("x3_clean_hourly",
    lambda s, d: rounded(cleaners.clean_hourly(t.wide(s, d).withColumn("sourceId", F.upper("datasourceId")), SPEC), "air"),
    f"SELECT * EXCLUDE (metric), round(metric + 1e-9, {PLACES}) AS air FROM chain WHERE is_valid", **_QC_VIEWS)


def _hot(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """A cleaner of one's own: only the hours above a level count."""
    return quality.metric_as(rollup.rollup_all(
        df.filter(values.quoted(spec.col_name) >= 50), spec.time_column, spec.col_name), spec.name)


def _custom(s, d) -> DataFrame:
    cleaners.register_cleaner("above_fifty", _hot)
    return cleaners.clean(t.wide(s, d), MetricSpec("air", t.VALUE, cleaner="above_fifty")).filter("type = 'hour'").select(
        *SENSOR, "date", "n_valid")


add("x6_register_cleaner", _custom,
    f"SELECT {KEYS}, {sql_hour_label('hour')} AS date, count(*) AS n_valid FROM "
    f"(SELECT *, date_trunc('hour', \"endOfPeriod\") AS hour FROM ev WHERE value >= 50) GROUP BY ALL")


def _stored(s, d, refresh: bool) -> DataFrame:
    """Two runs into one store: the whole table, then the half-month-later restatement."""
    spec = MetricSpec("air", t.VALUE, metric_select="only :pm25", qc=True,
                      rename_columns={"outputFrequency": "type", "endOfPeriod": "date"})
    rows = t.wide(s, d).withColumn("sourceId", F.upper("datasourceId"))
    later = (rows.withColumn("endOfPeriod", F.col("endOfPeriod") + F.expr("interval 15 days"))
             .withColumn(t.VALUE, values.quoted(t.VALUE) * 2))
    path = scratch_path(s, "store")
    metric_run.run_metric(s, spec, rows, path, refresh=refresh)
    return rounded(metric_run.run_metric(s, spec, later, path, refresh=refresh), "value").select(
        "type", "date", "datasourceId", "value")


_LATER_VIEWS = {
    **_QC_VIEWS,
    "lhours": 'SELECT * REPLACE (hour + INTERVAL 15 DAY AS hour, metric * 2 AS metric) FROM qhours',
    "ldays": f"SELECT {KEYS}, date_trunc('day', hour) AS day, count(*) AS n_valid, avg(metric) AS metric FROM lhours GROUP BY ALL",
    "lvdays": "SELECT * FROM ldays WHERE n_valid > 20",
    "lchain": _CHAIN.replace("FROM hours", "FROM lhours").replace("FROM days", "FROM ldays").replace("FROM vdays", "FROM lvdays"),
}

add("x5_run_metric", lambda s, d: _stored(s, d, False),
    f"""SELECT coalesce(n.type, o.type) AS type, coalesce(n.date, o.date) AS date,
        coalesce(n."datasourceId", o."datasourceId") AS "datasourceId", round(coalesce(n.metric, o.metric) + 1e-9, {PLACES}) AS value
        FROM (SELECT * FROM lchain WHERE is_valid) n FULL JOIN (SELECT * FROM chain WHERE is_valid) o
        ON n.type = o.type AND n.date = o.date AND n."datasourceId" = o."datasourceId" """, **_LATER_VIEWS)

add("x5_run_metric_refresh", lambda s, d: _stored(s, d, True),
    f"SELECT type, date, \"datasourceId\", round(metric + 1e-9, {PLACES}) AS value FROM rchain WHERE is_valid",
    rhours=f"""SELECT coalesce(n."datasourceId", o."datasourceId") AS "datasourceId", coalesce(n."sourceId", o."sourceId") AS "sourceId",
        coalesce(n.hour, o.hour) AS hour, coalesce(n.metric, o.metric) AS metric, 1 AS n_valid
        FROM lhours n FULL JOIN qhours o ON n.hour = o.hour AND n."datasourceId" = o."datasourceId" """,
    rdays=f"SELECT {KEYS}, date_trunc('day', hour) AS day, count(*) AS n_valid, avg(metric) AS metric FROM rhours GROUP BY ALL",
    rvdays="SELECT * FROM rdays WHERE n_valid > 20",
    rchain=_CHAIN.replace("FROM hours", "FROM rhours").replace("FROM days", "FROM rdays").replace("FROM vdays", "FROM rvdays"),
    **_LATER_VIEWS)
