"""The measurement store on disk: cells partitioned by type and calendar bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.operators.dataset import upsert_measurements
from smogline.operators.joins import null_safe_join
from smogline.schema import CELL, CELLS, SOURCE_CELL, SOURCE_CELLS, TYPE_ORDER, struct
from smogline.sources import versions

PARTITIONS = ["type", "bucket"]


def stored_schema(keys=CELL):
    cells = SOURCE_CELLS if list(keys) == SOURCE_CELL else CELLS
    return struct(**{f.name: f.dataType for f in cells.fields}, bucket=cells["date"].dataType)


STORED = stored_schema()


def with_bucket(cells: DataFrame) -> DataFrame:
    """Day of hours, month of days, year of everything longer: the unit an upsert rewrites."""
    date, kind = F.col("date"), F.col("type")
    return cells.withColumn("bucket", F.when(kind == "hour", F.substring(date, 1, 10)).when(kind == "day", F.substring(date, 1, 7))
                            .otherwise(F.substring(date, 1, 4)))


def table_of(keys) -> str:
    """Cells of single sources are a table of their own, under the same list as the store's cells."""
    return "sources" if list(keys) == SOURCE_CELL else ""


def read_store(spark: SparkSession, path: str, pairs=None, keys=CELL) -> DataFrame:
    """Every cell, or those of the (type, bucket) ``pairs``: no other folder is listed or read."""
    return versions.read(spark, path, stored_schema(keys), PARTITIONS, pairs, table_of(keys)).select(*keys, "value", "bucket")


def touched_partitions(cells: DataFrame) -> set[tuple]:
    """The (type, bucket) pairs of new cells; their number is bounded by the calendar."""
    return {(r["type"], r["bucket"]) for r in cells.select(*PARTITIONS).distinct().collect()}


def merge_into_store(spark: SparkSession, new: DataFrame, path: str, replace: DataFrame | None = None, keys=CELL) -> None:
    """Upsert cells, writing only the partitions they touch, once each. One writer at a time.
    ``keys`` say which table: those of cells, or of single sources' cells.

    Readers see the store before or after. A run that stops on the way has changed nothing,
    and what it left is removed by the next one that touches the same partitions. ``new`` is
    read more than once, so it should be stored rows (see ``cut``) and not a long
    computation. ``replace`` names cells (type, date, datasourceId) whose old values must
    not survive.
    """
    new, keys = with_bucket(new), list(keys)
    pairs = touched_partitions(new)
    gone = None
    if replace is not None:
        gone = with_bucket(replace).select(*CELL, "bucket").distinct()
        pairs |= touched_partitions(gone)
    if not pairs:
        return
    old = read_store(spark, path, pairs, keys)
    if gone is not None:
        old = null_safe_join(old, gone.select(*CELL), CELL, "left_anti")
    merged = with_bucket(upsert_measurements(old, new, keys)).filter(F.col("value").isNotNull())
    versions.write(merged.select(*stored_schema(keys).names), path, PARTITIONS,
                   [F.col("date").desc(), *[k for k in keys if k not in ("type", "date")]], pairs, table_of(keys))


def store_offsets(spark: SparkSession, path: str) -> DataFrame:
    """First row of each type in the latest-first matrix, from the counts kept per partition; 0 for absent types."""
    dates = dict.fromkeys(TYPE_ORDER[::-1], 0)
    for part in versions.parts(spark, path):
        dates[part.values[0]] += part.dates
    firsts, total = [], 0
    for period_type, n in dates.items():
        firsts.append((period_type, total if n else 0))
        total += n
    return spark.createDataFrame(firsts, "type string, first_row bigint")

