"""Latest values and histories per sensor, and map features."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.functions.features import json_text, to_geojson_feature
from smogline.operators.joins import lookup_join
from smogline.schema import FEATURE_METRICS


def latest_by_metric(rows: DataFrame, metrics=FEATURE_METRICS) -> DataFrame:
    """The newest value of each metric and the newest time per datasource.

    Missing values do not count; of two values at one time the greater is taken.
    """
    known = rows.filter(F.col("metric").isin(*metrics))
    return known.groupBy("datasourceId").agg(
        F.max("time").alias("time"),
        *[F.max(F.when((F.col("metric") == m) & F.col("value").isNotNull(),
                       F.struct("time", "value")))["value"].alias(m) for m in metrics])


def history_rows(rows: DataFrame, order_col: str, metrics=FEATURE_METRICS) -> DataFrame:
    """One value per datasource, metric and time: of repeated times the last row wins."""
    return (rows.filter(F.col("metric").isin(*metrics)).groupBy("datasourceId", "metric", "time")
            .agg(F.max(F.struct(order_col, "value"))["value"].alias("value")))


#: How much of a history one row may hold, and the length of the time text that names it.
PARTS = {"day": 10, "month": 7, "year": 4}


def history_by_metric(rows: DataFrame, order_col: str, metrics=FEATURE_METRICS, part: str = "day") -> DataFrame:
    """Maps from time to value, one per metric, for each datasource and day, month or year.

    A datasource's whole history in one map would grow without limit; this is a departure
    from a map per sensor. All metrics are present, empty where there is no value.
    """
    day = F.substring("time", 1, PARTS[part]).alias("part")
    entry = F.struct("time", "value")

    def timeline(m: str):
        entries = F.collect_list(F.when(F.col("metric") == m, entry))
        return F.map_from_entries(F.array_sort(entries)).alias(m)

    return (history_rows(rows, order_col, metrics).select("datasourceId", day, "metric", "time", "value")
            .groupBy("datasourceId", "part").agg(*[timeline(m) for m in metrics]))


def features_with_geometry(properties: DataFrame, locations: DataFrame, fetch_time: str | None = None) -> DataFrame:
    """One point feature per location that has properties, as JSON text.

    ``locations`` has ``datasourceId, lat, lon``. Use ``missing_properties`` for the
    locations left out.
    """
    columns = [c for c in properties.columns if c != "datasourceId"]
    joined = lookup_join(locations.select("datasourceId", "lat", "lon"), properties, ["datasourceId"], "inner")
    feature = to_geojson_feature(F.struct("datasourceId", *columns), "lon", "lat")
    return joined.select("datasourceId", F.lit(fetch_time).cast("string").alias("timestamp"),
                         json_text(feature).alias("feature"))


def missing_properties(properties: DataFrame, locations: DataFrame) -> DataFrame:
    """How many locations have no properties."""
    return (lookup_join(locations.select("datasourceId"), properties.select("datasourceId").distinct(),
                        ["datasourceId"], "left_anti")
            .agg(F.count("*").alias("locations_without_properties")))
