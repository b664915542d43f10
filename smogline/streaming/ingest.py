"""Landed files as a stream, and hourly means over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.functions.values import nan_to_null, quoted
from smogline.schema import SENSOR


def stream_measurements(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv",
                        files_per_batch: int | None = None) -> DataFrame:
    """New files of a landing folder, each read once for a given checkpoint.

    Files carry the columns of ``schema`` in order. NaN becomes null.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(folder)
    return rows.select(*[
        nan_to_null(quoted(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else quoted(f.name)
        for f in schema.fields])


def stream_hourly(rows: DataFrame, ts: str, col: str, lateness: str = "3 hours", min_obs: int = 1,
                  keys=SENSOR) -> DataFrame:
    """Hourly mean and count per sensor.

    Rows up to ``lateness`` behind the newest amend their hour, later ones are dropped.
    State holds the hours of that span only.
    """
    at = quoted(ts)
    return (
        rows.withColumn("_at", at.cast("timestamp")).withWatermark("_at", lateness)
        .groupBy(F.window("_at", "1 hour"), *keys)
        .agg(F.count(quoted(col)).alias("n_valid"), F.avg(quoted(col)).alias("metric"))
        .select(*keys, F.col("window.start").alias("hour"), "n_valid", "metric",
                (F.col("n_valid") >= min_obs).alias("is_valid"))
    )


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has landed so far into Parquet, then stop; the next run continues there."""
    query = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
             .option("path", path).trigger(availableNow=True).start())
    query.awaitTermination()
