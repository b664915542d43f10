"""The sensor-location table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.functions.geo import round_coord
from smogline.operators.dataset import first_per_key, order_sensors, upsert_locations
from smogline.operators.joins import lookup_join
from smogline.operators.spatial import assign_regions
from smogline.schema import LOCATION_COLUMNS, LOCATIONS, SENSOR
from smogline.session import cut, scratch_scope
from smogline.sources import versions
from smogline.sources.boundaries import LAYERS

ID_COLUMNS = ["datasourceId", "sourceId", "sourceType", "locationLatitude", "locationLongitude"]


def project_locations(measurements: DataFrame, order_cols: list[str]) -> DataFrame:
    """First row per sensor by the explicit order, coordinates rounded to four places."""
    first = first_per_key(measurements.select(*dict.fromkeys([*ID_COLUMNS, *order_cols])), SENSOR, order_cols)
    return first.select("datasourceId", "sourceId", "sourceType",
                        *[round_coord(c).alias(c) for c in ID_COLUMNS[3:]])


def join_datasources(locations: DataFrame, datasources: DataFrame) -> DataFrame:
    columns = ["datasourceId", "currentSubscriptionId", "currentSourceId", "name", "group", "tags"]
    return lookup_join(locations, datasources.select(*columns), ["datasourceId"], "left")


def build_locations(measurements: DataFrame, datasources: DataFrame, boundaries: dict[str, DataFrame],
                    order_cols: list[str]) -> DataFrame:
    """Locations with metadata, ward, community and zip; layers not given stay null.

    ``datasources`` is flat (``flatten_datasources``); ``boundaries`` maps layer names to edges.
    The readings are brought to one row per sensor, which is written once; what follows reads that.
    """
    located = join_datasources(cut(project_locations(measurements, order_cols)), datasources)
    for layer, columns in LAYERS.items():
        if layer in boundaries:
            located = assign_regions(located, boundaries[layer], list(columns.values()))
        else:
            located = located.select("*", *[F.lit(None).cast("string").alias(c) for c in columns.values()])
    return order_sensors(located.select(*LOCATION_COLUMNS))


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """The stored location table, sorted by sensor; empty when there is none."""
    return order_sensors(versions.read(spark, path, LOCATIONS, []))


def merge_locations(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """Merge locations into the stored table, column by column, and store the result.

    Values of ``new`` win, nulls in it erase nothing, and merging the same rows again changes
    nothing. Columns the table does not have are left out. The table has one row per sensor: of
    several, as of one in overlapping regions, the first in order of the columns is taken.
    Readers see the table before or after.
    """
    known = {f.name: f.dataType for f in LOCATIONS}
    with scratch_scope(spark):
        columns = [c for c in new.columns if c in known]
        typed = new.select(*[F.col(c).cast(known[c]) for c in columns])
        fresh = cut(first_per_key(typed, SENSOR, [F.col(c).asc_nulls_last() for c in columns]))
        merged = upsert_locations(versions.read(spark, path, LOCATIONS, []), fresh)
        versions.write(merged.select(*LOCATION_COLUMNS), path, [], [F.col(k) for k in SENSOR], {()})
    return read_locations(spark, path)


def merge_location_file(spark: SparkSession, path: str, parquet: str) -> DataFrame:
    """Merge a supplied Parquet table of locations; it needs the sensor's ids and any further columns."""
    return merge_locations(spark, path, spark.read.parquet(parquet))


def update_locations(spark: SparkSession, path: str, measurements: DataFrame, datasources: DataFrame,
                     boundaries: dict[str, DataFrame], order_cols: list[str]) -> DataFrame:
    """Renew the stored locations from readings, as every run does."""
    return merge_locations(spark, path, build_locations(measurements, datasources, boundaries, order_cols))
