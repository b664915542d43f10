"""Sensor-shaped views of the given tables, in Spark and as SQL.

Every view reads a whole table. ``CTES[name]`` is the SQL of the view ``name``;
``with_views`` puts the needed ones before a query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.functions.labels import floor_hour

VALUE = "pm2_5ConcMass1HourMean.value"
ASSESSMENT = "pm2_5ConcMass1HourMean.qcAssessment"
GAS = "no2Conc1HourMean.value"
GAS_ASSESSMENT = "no2Conc1HourMean.qcAssessment"
INDEX = "pm2_5ConcMassNowcastUsEpaAqi.value"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; zone-less times are taken as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c)
                       for c, t in df.dtypes])


def as_double(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def events(spark, folder) -> DataFrame:
    """One reading per event; the sensor is the event type with three sources."""
    return table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("datasourceId"),
        F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("sourceId"),
        F.col("ts").alias("endOfPeriod"), "value", "user_id",
        F.when(F.col("event_type") == "error", "invalid").when(F.col("event_type") != "signup", "valid").alias("qc"),
        (as_double("user_id") / 1000 + 41).alias("lat"),
        (as_double(F.col("event_id") % 4000) / 3200 - 88).alias("lon"))


def wide(spark, folder) -> DataFrame:
    """Events with the column names of hourly sensor files."""
    return events(spark, folder).select(
        "datasourceId", "sourceId", F.lit("CLOUD").alias("sourceType"),
        F.col("lat").alias("locationLatitude"), F.col("lon").alias("locationLongitude"), "endOfPeriod",
        F.lit("hour").alias("outputFrequency"),
        F.col("value").alias(VALUE), F.col("qc").alias(ASSESSMENT),
        (F.col("value") / 2).alias(GAS), F.col("qc").alias(GAS_ASSESSMENT),
        (F.col("value") * 2).alias(INDEX), "event_id")


def hourly(spark, folder) -> DataFrame:
    """Events with one source per type: dense enough for valid days."""
    return events(spark, folder).withColumn("sourceId", F.upper("datasourceId"))


def daily(spark, folder) -> DataFrame:
    """Lineitems as days of 21 sensors: valid and invalid periods at every level."""
    return (table(spark, folder, "lineitem")
            .groupBy(F.col("l_returnflag").alias("datasourceId"),
                     F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("sourceId"),
                     F.col("l_shipdate").alias("day"))
            .agg(F.avg("l_quantity").alias("metric"), F.count("*").alias("n_valid"))
            .withColumn("is_valid", F.lit(True)))


def grid(spark, folder, flat: bool = False) -> DataFrame:
    """A row for every hour between each event type's first and last hour, null where no event fell."""
    means = (table(spark, folder, "events")
             .groupBy(F.col("event_type").alias("datasourceId"), floor_hour("ts").alias("time"))
             .agg(F.avg("value").alias("m")))
    hours = (means.groupBy("datasourceId").agg(F.min("time").alias("a"), F.max("time").alias("b"))
             .select("datasourceId", F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("time")))
    value = F.col("m") / 10 + 100
    if flat:
        value = F.when(F.col("m").isNotNull() & (F.dayofmonth("time") % 7 == 0) & (F.hour("time") < 16),
                       F.lit(142.0)).otherwise(value)
    return hours.join(means, ["datasourceId", "time"], "left").select(
        "datasourceId", F.upper("datasourceId").alias("sourceId"), "time", value.alias("value"),
        (F.ascii("datasourceId") / F.lit(100.0) + 41).alias("locationLatitude"),
        (F.lit(-87.0) - F.ascii(F.substring("datasourceId", 2, 1)) / F.lit(100.0)).alias("locationLongitude"))


def long_grid(spark, folder) -> DataFrame:
    """Orders as an hourly grid of twelve sensors that grows with the tables: about 15 % of the values
    are missing, alone, close to one another, and in runs of four."""
    i, n = F.floor(F.col("o_orderkey") / 12), F.col("o_orderkey") % 12
    missing = ((i + n * 5) % 17 == 3) | ((i + n) % 41).isin(10, 13) | ((i + n * 3) % 101).between(50, 53)
    value = as_double(i % 24) / 4 + as_double(n) / 8 + 100 + F.when(F.col("o_orderkey") % 29 == 0, 40.0).otherwise(0.0)
    name = F.concat(F.lit("o"), n.cast("string"))
    return table(spark, folder, "orders").select(
        name.alias("datasourceId"), F.upper(name).alias("sourceId"),
        F.timestamp_seconds(F.lit(1704067200) + i * 3600).alias("time"), F.when(~missing, value).alias("value"),
        (as_double(n) / 100 + 41).alias("locationLatitude"), (F.lit(-87.0) - as_double(n * 7 % 12) / 100).alias("locationLongitude"))


def uneven(spark, folder) -> DataFrame:
    """Wide events of which one source has most readings and two greater ones a few."""
    return wide(spark, folder).withColumn("sourceId", F.concat(F.lit("S"), F.greatest(F.col("event_id") % 10 - 7, F.lit(0)).cast("string")))


def places(spark, folder) -> DataFrame:
    """Customers as sensors with coordinates."""
    return table(spark, folder, "customer").select(
        F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("key"),
        (as_double((F.col("c_custkey") * 104729) % 9973) / 9973 * 1.5 + 41.0001).alias("lat"),
        (as_double((F.col("c_custkey") * 7919) % 10007) / 10007 * 2 - 88.0003).alias("lon"))


_CORNERS = [(1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)]
RINGS = [(ring, seq, *corner, half) for ring, half in ((0, 0.21), (1, 0.07))
         for seq, corner in enumerate(_CORNERS)]


def regions(spark, folder) -> DataFrame:
    """Nations as overlapping diamonds with a diamond hole."""
    center_x = as_double(F.col("n_nationkey") % 5) * 0.4 - 87.8
    center_y = as_double(F.floor(F.col("n_nationkey") / 5)) * 0.3 + 41.15
    edge = F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("ring", "seq", "a", "b", "c", "d", "half"), r)])
        for r in RINGS])).alias("e")
    return (table(spark, folder, "nation")
            .select("n_nationkey", F.col("n_name").alias("ward"), center_x.alias("x"), center_y.alias("y"), edge)
            .select(F.lit("wards").alias("layer"), F.col("n_nationkey").cast("string").alias("region_id"),
                    "ward", F.lit(0).alias("part"), "e.ring", "e.seq",
                    (F.col("x") + F.col("e.a") * F.col("e.half")).alias("x1"),
                    (F.col("y") + F.col("e.b") * F.col("e.half")).alias("y1"),
                    (F.col("x") + F.col("e.c") * F.col("e.half")).alias("x2"),
                    (F.col("y") + F.col("e.d") * F.col("e.half")).alias("y2")))


def poles(spark, folder) -> DataFrame:
    """Lineitems as light poles: the order is the site, the line number the candidate."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sensorID"), F.col("l_linenumber").alias("Candidate"),
        (F.col("l_orderkey") % 77).cast("int").alias("ComArea"),
        (F.col("l_orderkey") % 50).cast("int").alias("Ward"),
        F.when(F.col("l_orderkey") % 20 == 0, -1).otherwise(F.col("l_orderkey") % 60).cast("int").alias("Zip"),
        F.concat(F.lit("F"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("FEATURE_ID"),
        F.concat(F.col("l_partkey").cast("string"), F.lit(" Main St")).alias("Address"),
        (as_double("l_suppkey") / 8 + 41).alias("Latitude"), (as_double("l_partkey") / -16 - 87).alias("Longitude"),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("_ord"))


def sites(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("EPA Grid Point ID"), (F.col("o_orderkey") % 60).cast("int").alias("Zipcode"),
        (F.col("o_orderkey") % 77).cast("int").alias("Community Area Number"),
        (F.col("o_orderkey") % 50).cast("int").alias("Ward Number"))


def datasources(spark, folder) -> DataFrame:
    """Event types described by nested metadata; one of them is not known there."""
    return (table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
            .filter("event_type <> 'view'")
            .select(F.col("event_type").alias("datasourceId"),
                    F.concat(F.lit("sub-"), "event_type").alias("currentSubscriptionId"),
                    F.concat(F.lit("cur-"), F.upper("event_type")).alias("currentSourceId"),
                    F.struct(F.initcap("event_type").alias("name"),
                             F.when(F.length("event_type") > 5, F.lit("long")).alias("group"),
                             F.array(F.lit("tag"), "event_type").alias("tags")).alias("orgAnnotations")))


METRIC_OF = {"click": "pm10ConcMassNowcast", "error": "pm10ConcMassNowcastUsEpaAqi",
             "purchase": "pm2_5ConcMassNowcast"}


def long_rows(spark, folder) -> DataFrame:
    """Events as long rows: the user is the datasource, the type decides the metric; times by day."""
    metric = F.lit("pm2_5ConcMassNowcastUsEpaAqi")
    for event_type, name in METRIC_OF.items():
        metric = F.when(F.col("event_type") == event_type, name).otherwise(metric)
    return table(spark, folder, "events").select(
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("datasourceId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:'00:00.000Z'").alias("time"), metric.alias("metric"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"), "event_id")


CTES = {
    "ev": """SELECT event_id, event_type AS "datasourceId", 'S' || CAST(user_id % 3 AS VARCHAR) AS "sourceId",
        ts AS "endOfPeriod", value, user_id,
        CASE WHEN event_type = 'error' THEN 'invalid' WHEN event_type <> 'signup' THEN 'valid' END AS qc,
        CAST(user_id AS DOUBLE) / 1000 + 41 AS lat,
        CAST(event_id % 4000 AS DOUBLE) / 3200 - 88 AS lon FROM events""",
    "ho": """SELECT * REPLACE (upper("datasourceId") AS "sourceId") FROM ev""",
    "hours": """SELECT "datasourceId", "sourceId", date_trunc('hour', "endOfPeriod") AS hour,
        count(value) AS n_valid, avg(value) AS metric FROM ho GROUP BY ALL""",
    "hours3": """SELECT "datasourceId", "sourceId", date_trunc('hour', "endOfPeriod") AS hour,
        count(value) AS n_valid, avg(value) AS metric FROM ev GROUP BY ALL""",
    "days": """SELECT "datasourceId", "sourceId", date_trunc('day', hour) AS day, count(*) AS n_valid,
        avg(metric) AS metric FROM hours GROUP BY ALL""",
    "da": """SELECT l_returnflag AS "datasourceId", 'L' || CAST(l_linenumber AS VARCHAR) AS "sourceId",
        l_shipdate AS day, avg(l_quantity) AS metric FROM lineitem GROUP BY ALL""",
    "lg": """SELECT "datasourceId", upper("datasourceId") AS "sourceId", TIMESTAMP '2024-01-01' + to_hours(i) AS time,
        CASE WHEN NOT ((i + n * 5) % 17 = 3 OR (i + n) % 41 IN (10, 13) OR (i + n * 3) % 101 BETWEEN 50 AND 53)
        THEN CAST(i % 24 AS DOUBLE) / 4 + CAST(n AS DOUBLE) / 8 + 100 + CASE WHEN o_orderkey % 29 = 0 THEN 40.0e0 ELSE 0.0e0 END END AS value,
        CAST(n AS DOUBLE) / 100 + 41 AS lat, -87.0e0 - CAST(n * 7 % 12 AS DOUBLE) / 100 AS lon
        FROM (SELECT o_orderkey, o_orderkey // 12 AS i, o_orderkey % 12 AS n, 'o' || CAST(o_orderkey % 12 AS VARCHAR) AS "datasourceId" FROM orders)""",
    "un": """SELECT * REPLACE ('S' || CAST(greatest(event_id % 10 - 7, 0) AS VARCHAR) AS "sourceId") FROM ev""",
    "means": """SELECT event_type AS "datasourceId", date_trunc('hour', ts) AS time, avg(value) AS m
        FROM events GROUP BY ALL""",
    "span": """SELECT "datasourceId", unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time
        FROM means GROUP BY "datasourceId" """,
    "gr": """SELECT s."datasourceId", upper(s."datasourceId") AS "sourceId", s.time,
        m / 10 + 100 AS value,
        ascii(s."datasourceId") / 100.0e0 + 41 AS lat, -87.0e0 - ascii(substr(s."datasourceId", 2, 1)) / 100.0e0 AS lon
        FROM span s LEFT JOIN means USING ("datasourceId", time)""",
    "grf": """SELECT * REPLACE (CASE WHEN value IS NOT NULL AND day(time) % 7 = 0 AND hour(time) < 16
        THEN 142.0e0 ELSE value END AS value) FROM gr""",
    "pl": """SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS key,
        CAST((c_custkey * 104729) % 9973 AS DOUBLE) / 9973 * 1.5e0 + 41.0001e0 AS lat,
        CAST((c_custkey * 7919) % 10007 AS DOUBLE) / 10007 * 2 - 88.0003e0 AS lon FROM customer""",
    "re": "SELECT n_nationkey, n_name AS ward, x + a * half AS x1, y + b * half AS y1, x + c * half AS x2, "
          "y + d * half AS y2 FROM (SELECT n_nationkey, n_name, CAST(n_nationkey % 5 AS DOUBLE) * 0.4e0 - 87.8e0 AS x, "
          "CAST(n_nationkey // 5 AS DOUBLE) * 0.3e0 + 41.15e0 AS y FROM nation), (VALUES "
          + ", ".join(f"({a}, {b}, {c}, {d}, {half}e0)" for _, _, a, b, c, d, half in RINGS)
          + ") AS v(a, b, c, d, half)",
    "po": """SELECT l_orderkey AS sensor, l_linenumber AS candidate, l_orderkey % 77 AS area, l_orderkey % 50 AS ward,
        CASE WHEN l_orderkey % 20 = 0 THEN -1 ELSE l_orderkey % 60 END AS zip,
        'F' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS fid,
        CAST(l_partkey AS VARCHAR) || ' Main St' AS addr,
        CAST(l_suppkey AS DOUBLE) / 8 + 41 AS lat, CAST(l_partkey AS DOUBLE) / -16 - 87 AS lon,
        l_partkey * 100000 + l_suppkey AS ord FROM lineitem""",
    "si": """SELECT o_orderkey AS sensor, o_orderkey % 60 AS zip, o_orderkey % 77 AS area, o_orderkey % 50 AS ward
        FROM orders""",
    "lo": "SELECT 'D' || CAST(user_id AS VARCHAR) AS \"datasourceId\", strftime(ts, '%Y-%m-%dT%H:00:00.000Z') AS time, "
          "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_OF.items())
          + " ELSE 'pm2_5ConcMassNowcastUsEpaAqi' END AS metric, "
          "CASE WHEN event_type <> 'view' THEN value END AS value, event_id FROM events",
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """The query with the views it uses, and theirs, in front."""
    views = {**CTES, **(extra or {})}
    needed: list[str] = []
    open_: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b\w+\b", text):
            if name in views and name not in needed and name not in open_:
                open_.add(name)
                visit(views[name])
                needed.append(name)

    visit(sql)
    recursive = "RECURSIVE " if any("UNION ALL" in views[n] and re.search(rf"\bFROM {n}\b", views[n]) for n in needed) else ""
    return (f"WITH {recursive}" + ", ".join(f"{n} AS ({views[n]})" for n in needed) + " " + sql) if needed else sql


def sql_hour_label(h: str) -> str:
    return f"CASE WHEN hour({h}) = 0 THEN strftime({h}, '%Y-%m-%d') ELSE strftime({h}, '%Y-%m-%d %H:%M:%S') END"


def sql_season(d: str) -> str:
    return (f"CASE WHEN month({d}) BETWEEN 3 AND 5 THEN 'spring' WHEN month({d}) BETWEEN 6 AND 8 THEN 'summer' "
            f"WHEN month({d}) BETWEEN 9 AND 11 THEN 'autumn' ELSE 'winter' END")


def sql_label(level: str, d: str) -> str:
    return {
        "week": f"strftime({d}, '%G-W%V')", "month": f"strftime({d}, '%Y-%m')",
        "season": f"CAST(year({d}) + CASE WHEN month({d}) = 12 THEN 1 ELSE 0 END AS VARCHAR) || '-' || {sql_season(d)}",
        "year": f"CAST(year({d}) AS VARCHAR)", "day": f"strftime({d}, '%Y-%m-%d')", "hour": sql_hour_label(d),
    }[level]


SQL_RANK = ("CASE type WHEN 'year' THEN 0 WHEN 'season' THEN 1 WHEN 'month' THEN 2 WHEN 'week' THEN 3 "
            "WHEN 'day' THEN 4 WHEN 'hour' THEN 5 END")


def sql_haversine(a: str, b: str, c: str, d: str) -> str:
    h = (f"least(1.0e0, sin(radians({c} - {a}) / 2) * sin(radians({c} - {a}) / 2) + cos(radians({a})) * cos(radians({c})) "
         f"* sin(radians({d} - {b}) / 2) * sin(radians({d} - {b}) / 2))")
    return f"2 * 6371.0e0 * atan2(sqrt({h}), sqrt(1.0e0 - {h}))"
