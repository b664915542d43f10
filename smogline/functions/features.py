"""Map features as structs and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_geojson_feature(properties: Column, lon, lat) -> Column:
    """A point feature; coordinates are longitude first."""
    return F.struct(
        F.lit("Feature").alias("type"),
        properties.alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col(lon) if isinstance(lon, str) else lon,
                         F.col(lat) if isinstance(lat, str) else lat).alias("coordinates"),
                 ).alias("geometry"),
    )


def json_text(value: Column) -> Column:
    """JSON that spells out nulls."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, so that JSON holds numbers."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
