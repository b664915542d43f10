"""GeoJSON boundary layers, sensor metadata and candidate sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.schema import POLES

_FEATURES = ("features array<struct<properties: map<string,string>, "
             "geometry: struct<type: string, coordinates: string>>>")
_RINGS = "array<array<array<double>>>"

# Properties of the three boundary layers and the columns they become.
LAYERS = {
    "wards": {"ward": "ward"},
    "communities": {"community": "community", "area_numbe": "comarea"},
    "zips": {"zip": "zip"},
}


def read_boundaries(spark: SparkSession, path: str, layer: str, columns: dict[str, str] | None = None) -> DataFrame:
    """One row per polygon edge, with the chosen properties of its region.

    A region is one feature; ``part`` counts the polygons of a multipolygon and
    ``ring`` the outer ring (0) and holes.
    """
    columns = LAYERS[layer] if columns is None else columns
    features = (
        spark.read.text(path, wholetext=True)
        .select(F.from_json("value", _FEATURES).alias("doc"))
        .select(F.posexplode("doc.features").alias("_n", "f"))
    )
    shape = F.col("f.geometry.coordinates")
    polygons = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(shape, _RINGS))) \
        .when(F.col("f.geometry.type") == "MultiPolygon", F.from_json(shape, f"array<{_RINGS}>"))
    return (
        features
        .select(F.lit(layer).alias("layer"), F.col("_n").cast("string").alias("region_id"),
                *[F.col("f.properties")[p].alias(c) for p, c in columns.items()],
                F.posexplode(polygons).alias("part", "rings"))
        .select("layer", "region_id", *columns.values(), "part",
                F.posexplode("rings").alias("ring", "points"))
        .withColumn("n", F.size("points") - 1)
        .filter("n > 0")
        .select("layer", "region_id", *columns.values(), "part", "ring",
                F.posexplode(F.arrays_zip(F.expr("slice(points, 1, n)").alias("a"),
                                          F.expr("slice(points, 2, n)").alias("b"))).alias("seq", "e"))
        .select("layer", "region_id", *columns.values(), "part", "ring", "seq",
                F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
                F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))
    )


def flatten_datasources(df: DataFrame) -> DataFrame:
    """Nested sensor metadata as flat columns."""
    return df.select("datasourceId", "currentSubscriptionId", "currentSourceId",
                     *[F.col(f"orgAnnotations.{c}").alias(c) for c in ("name", "group", "tags")])


def read_candidates(spark: SparkSession, path, schema=POLES) -> DataFrame:
    """A CSV of light poles or of sites to fill, matched to ``schema`` by column name."""
    text = spark.read.option("header", True).csv(path)
    return text.select(*[
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in text.columns
        else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
