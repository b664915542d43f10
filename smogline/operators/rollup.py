"""Chained rollups from readings to hours, days, weeks, months, seasons and years."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.functions.labels import LABELS, day_label, floor_day, floor_hour, hour_label
from smogline.functions.values import nan_to_null, quoted
from smogline.operators.quality import keep_valid
from smogline.schema import MIN_PARTS, SENSOR

PERIOD_COLUMNS = ["date", "type", "metric", "n_valid", "is_valid"]


def rollup_hour(df: DataFrame, ts: str, col: str, min_obs: int = 1, keys=SENSOR) -> DataFrame:
    """Mean and number of readings per sensor and hour; ``hour`` is the timestamp.

    Count and average combine on the map side, so a busy sensor sends one partial
    row per hour and task. Missing readings, null or NaN, count for nothing.
    """
    value = nan_to_null(quoted(col).cast("double"))
    return (
        df.groupBy(*keys, floor_hour(quoted(ts)).alias("hour"))
        .agg(F.count(value).alias("n_valid"), F.avg(value).alias("metric"))
        .withColumn("is_valid", F.col("n_valid") >= min_obs)
    )


def rollup_day(hours: DataFrame, gt: int = MIN_PARTS["day"], keys=SENSOR) -> DataFrame:
    """Mean of the valid hourly means; ``day`` is the timestamp."""
    return (
        keep_valid(hours).groupBy(*keys, floor_day("hour").alias("day"))
        .agg(F.count("*").alias("n_valid"), F.avg("metric").alias("metric"))
        .withColumn("is_valid", F.col("n_valid") > gt)
    )


def rollup_days(days: DataFrame, limits: dict[str, int], keys=SENSOR) -> DataFrame:
    """All the requested levels above days in one grouping.

    Every valid day is counted towards its week, month, season and year at once, which
    takes one shuffle instead of one per level.
    """
    periods = F.explode(F.array(*[
        F.struct(F.lit(level).alias("type"), LABELS[level](F.col("day")).alias("date"))
        for level in limits])).alias("p")
    limit = reduce(lambda c, level: c.when(F.col("type") == level, limits[level]), limits, F)
    return (
        keep_valid(days).select(*keys, "metric", periods)
        .select(*keys, "p.type", "p.date", "metric")
        .groupBy(*keys, "date", "type")
        .agg(F.avg("metric").alias("metric"), F.count("*").alias("n_valid"))
        .withColumn("is_valid", F.col("n_valid") > limit)
    )


def rollup_week(days: DataFrame, gt: int = MIN_PARTS["week"], keys=SENSOR) -> DataFrame:
    return rollup_days(days, {"week": gt}, keys)


def rollup_month(days: DataFrame, gt: int = MIN_PARTS["month"], keys=SENSOR) -> DataFrame:
    return rollup_days(days, {"month": gt}, keys)


def rollup_season(days: DataFrame, gt: int = MIN_PARTS["season"], keys=SENSOR) -> DataFrame:
    return rollup_days(days, {"season": gt}, keys)


def rollup_year(days: DataFrame, gt: int = MIN_PARTS["year"], keys=SENSOR) -> DataFrame:
    return rollup_days(days, {"year": gt}, keys)


def label_hours(hours: DataFrame, keys=SENSOR) -> DataFrame:
    return hours.select(*keys, hour_label("hour").alias("date"), F.lit("hour").alias("type"),
                        "metric", "n_valid", "is_valid")


def label_days(days: DataFrame, keys=SENSOR) -> DataFrame:
    return days.select(*keys, day_label("day").alias("date"), F.lit("day").alias("type"),
                       "metric", "n_valid", "is_valid")


def union_levels(levels: dict[str, DataFrame]) -> DataFrame:
    """Concatenate period levels by name; each gets its constant type and text dates."""
    typed = [df.withColumn("type", F.lit(level)).withColumn("date", F.col("date").cast("string"))
             for level, df in levels.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)


def rollup_all(df: DataFrame, ts: str, col: str, min_obs: int = 1, limits: dict[str, int] | None = None,
               only_valid: bool = True, keys=SENSOR) -> DataFrame:
    """Every level as one long frame.

    Hours feed three branches and days two; their shuffles are equal sub-plans, which
    Spark runs once and reuses, so nothing needs to be cached.
    """
    limits = {**MIN_PARTS, **(limits or {})}
    hours = rollup_hour(df, ts, col, min_obs, keys)
    days = rollup_day(hours, limits["day"], keys)
    upper = rollup_days(days, {k: limits[k] for k in ("year", "season", "month", "week")}, keys)
    columns = [*keys, *PERIOD_COLUMNS]
    levels = upper.select(*columns).unionByName(label_days(days, keys)).unionByName(label_hours(hours, keys))
    return keep_valid(levels) if only_valid else levels
