"""The measurement store: cells, upserts, the sensors-as-columns view, order and offsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.labels import type_rank
from smogline.functions.values import present, quoted
from smogline.operators.quality import filter_time
from smogline.schema import CELL, SENSOR, TYPE_ORDER


def filter_type(df: DataFrame, period_type: str, ts_col: str | None = None, start=None, end=None) -> DataFrame:
    """Rows of one period type (a partition of the store), in a time range when given."""
    df = df.filter(F.col("type") == period_type)
    return filter_time(df, ts_col, start, end) if ts_col else df


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The first row of each key. Spark files have no row order, so the order is explicit.

    The row-number filter is applied before the shuffle too: a hot key sends one row per task.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
    return df.withColumn("_rn", first).filter("_rn = 1").drop("_rn")


def sensor_cells(periods: DataFrame, metric: str = "metric") -> DataFrame:
    """One value per (type, date, datasource): of several sources the greatest id wins,
    sources without a value never do. Cells without any value are absent."""
    value = present(metric)
    # A missing source id sorts last, after every other.
    rank = F.coalesce("sourceId", F.lit("￿"))
    return (periods.filter(value.isNotNull()).groupBy(*CELL)
            .agg(F.max_by(value, rank).alias("value")))


def pivot_sensors(periods: DataFrame, metric: str = "metric", sensors: list[str] | None = None) -> DataFrame:
    """The measurement matrix: one row per (type, date), one column per datasource.

    Give ``sensors`` to fix the columns and save the job that looks them up; the number
    of columns is limited by ``spark.sql.pivotMaxValues``.
    """
    return pivot_cells(sensor_cells(periods, metric), sensors)


def pivot_cells(cells: DataFrame, sensors: list[str] | None = None) -> DataFrame:
    grouped = cells.groupBy("type", "date")
    by_sensor = grouped.pivot("datasourceId", sensors) if sensors else grouped.pivot("datasourceId")
    return by_sensor.agg(F.max("value"))


def unpivot_sensors(matrix: DataFrame) -> DataFrame:
    """Back from the matrix to cells; empty cells are dropped."""
    sensors = [c for c in matrix.columns if c not in ("type", "date")]
    return matrix.unpivot(["type", "date"], [quoted(c) for c in sensors], "datasourceId", "value").filter(
        present("value").isNotNull())


def upsert_measurements(existing: DataFrame, new: DataFrame, keys=CELL) -> DataFrame:
    """New values win, old ones stay where the new side has none (null or NaN); rows and sensors unite.

    Both sides hold one row per cell, as ``sensor_cells`` gives them. Grouping the union
    takes one shuffle with map-side combining where an outer join would take two.
    """
    columns = [*keys, "value"]
    both = (existing.select(*columns, F.lit(False).alias("_new"))
            .unionByName(new.select(*columns, F.lit(True).alias("_new")))).withColumn("value", present("value"))
    return both.groupBy(*keys).agg(F.coalesce(
        F.max(F.when(F.col("_new"), F.col("value"))),
        F.max(F.when(~F.col("_new"), F.col("value")))).alias("value"))


def upsert_locations(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Merge sensor locations column by column, new values first; columns unite. Sorted by sensor.

    A null id equals a null id, so merging a table with itself changes nothing.
    """
    columns = list(dict.fromkeys([*new.columns, *existing.columns]))
    old, fresh = existing.alias("o"), new.alias("n")

    def merged(c: str):
        sides = [F.col(f"{a}.`{c}`") for a, d in (("n", new), ("o", existing)) if c in d.columns]
        return F.coalesce(*sides).alias(c)

    match = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in SENSOR])
    return order_sensors(fresh.join(old, match, "full").select(*[merged(c) for c in columns]))


def combine_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct union by column name; columns of one side only are null on the other."""
    return a.unionByName(b, allowMissingColumns=True).distinct()


def order_latest_first(df: DataFrame) -> DataFrame:
    """Hours first, dates as text descending. The sensor breaks ties where there is one,
    so that a range partition never has to hold one crowded date."""
    keys = [type_rank().desc(), F.col("date").desc()]
    return df.orderBy(*keys, *[F.col(k) for k in SENSOR if k in df.columns])


def order_sensors(df: DataFrame) -> DataFrame:
    return df.orderBy(*SENSOR)


def type_offsets(matrix: DataFrame) -> DataFrame:
    """First row of each type in latest-first order, from six counts; 0 for absent types."""
    finest_first = TYPE_ORDER[::-1]
    counts = matrix.agg(*[F.count_if(F.col("type") == t).alias(t) for t in finest_first])
    total, parts = F.lit(0).cast("bigint"), []
    for t in finest_first:
        parts += [F.lit(t), F.when(F.col(t) > 0, total).otherwise(F.lit(0).cast("bigint"))]
        total = total + F.col(t)
    return counts.select(F.stack(F.lit(len(finest_first)), *parts).alias("type", "first_row"))


def preview(df: DataFrame, order_cols: list[str], n: int = 6) -> DataFrame:
    return df.orderBy(*order_cols).limit(n)
