"""Run the requested metrics from landed readings to the updated store."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.functions.labels import LABELS, day_label
from smogline.functions.values import qc_column_for, quoted
from smogline.operators.dataset import pivot_cells, sensor_cells
from smogline.operators.joins import null_safe_join
from smogline.operators.quality import filter_time, keep_valid, rename_columns, select_metrics, validity_summary
from smogline.operators.rollup import label_days, rollup_day, rollup_days
from smogline.plans.cleaners import clean
from smogline.plans.locations import update_locations
from smogline.plans.store import merge_into_store, read_store, store_offsets
from smogline.schema import CELL, DEFAULT_METRICS, METRICS, MIN_PARTS, SENSOR, SOURCE_CELL, MetricSpec
from smogline.session import cut, scratch_scope
from smogline.sources import versions
from smogline.sources.sinks import write_type_offsets

log = logging.getLogger(__name__)

# Which metrics a ``:group`` stands for is the data provider's business; this is a default.
METRIC_GROUPS = {"pm25": ["pm2_5*"], "no2": ["no2*"], "internal": ["*Internal*"]}


def requested_metrics(names=None) -> list[MetricSpec]:
    """Specs of the named metrics; ``None`` or ``"*"`` means the default ones. Unknown names
    are reported and skipped."""
    names = DEFAULT_METRICS if names in (None, "*", ["*"]) else names
    unknown = [n for n in names if n not in METRICS]
    if unknown:
        log.error("unknown metrics skipped: %s", unknown)
    return [METRICS[n] for n in names if n in METRICS]


def metric_periods(spec: MetricSpec, source: DataFrame, start=None, end=None, groups=None) -> DataFrame:
    """Valid periods of one metric per sensor, at every level."""
    chosen = select_metrics(source, spec.metric_select, METRIC_GROUPS if groups is None else groups)
    ranged = filter_time(chosen, spec.time_column, start, end)
    return rename_columns(clean(ranged, spec), spec.rename_columns)


def metric_cells(spec: MetricSpec, source: DataFrame, start=None, end=None, groups=None) -> DataFrame:
    """Valid periods of one metric as store cells."""
    return sensor_cells(metric_periods(spec, source, start, end, groups), spec.name)


def quality_counts(spec: MetricSpec, source: DataFrame) -> DataFrame:
    """Rows before and after the quality filter, in one pass over the readings."""
    kept = F.lit(True)
    if spec.drops_invalid:
        kept = ~quoted(qc_column_for(spec.col_name)).eqNullSafe(F.lit("invalid"))
    return source.agg(F.count("*").alias("rows_all"), F.count_if(kept).alias("rows_kept"))


def source_cells(periods: DataFrame, metric: str, types=("hour", "day")) -> DataFrame:
    """Hours and days of every single source, from which longer periods can be made again."""
    return (periods.filter(F.col("type").isin(*types) & quoted(metric).isNotNull())
            .select(*SOURCE_CELL, quoted(metric).alias("value")))


@contextmanager
def store_change(spark: SparkSession, store: str, mark: tuple[str, int] | None = None) -> Iterator[None]:
    """One change of a store: single sources' hours and days, cells and their counts become current together.

    The offset index file is made from the published counts, so it can only lag, until the next change or replay.
    """
    with versions.change(spark, store, mark):
        yield
    write_index(spark, store)


def write_index(spark: SparkSession, store: str) -> None:
    write_type_offsets(store_offsets(spark, store), f"{store}.index.json")


def run_metric(spark: SparkSession, spec: MetricSpec, source: DataFrame, store: str, start=None, end=None,
               groups=None, refresh: bool = False, count_rows: bool = False) -> DataFrame:
    """Clean ``source``, merge it into the store and renew its offset index.

    Periods above hours come from the given readings alone, as a run over a whole period
    would have them. With ``refresh`` the periods that the new hours fall in are computed
    again from all stored hours, and those no longer valid are removed. Hours and days of
    single sources are kept beside the store: of a datasource's sources one is chosen only
    after the rollup, never mixed. ``count_rows`` logs rows before and after the quality filter and the
    valid periods, which takes a pass over the readings. What the run wrote for itself is removed.
    """
    with scratch_scope(spark):
        if count_rows:
            ranged = filter_time(source, spec.time_column, start, end)
            log.info("%s: %s", spec.name, quality_counts(spec, ranged).first().asDict())
        periods = cut(metric_periods(spec, source, start, end, groups))
        if count_rows:
            log.info("%s: %s", spec.name, {r["type"]: r["rows_valid"] for r in validity_summary(periods).collect()})
        with store_change(spark, store):
            if refresh:
                merge_hours(spark, cut(source_cells(periods, spec.name, ("hour",))), store)
            else:
                merge_into_store(spark, cut(source_cells(periods, spec.name)), store, keys=SOURCE_CELL)
                merge_into_store(spark, cut(sensor_cells(periods, spec.name)), store)
    return read_store(spark, store)


def run_metrics(spark: SparkSession, source_of: Callable[[MetricSpec], DataFrame], root: str, names=None,
                window: tuple | None = None, locations: dict | None = None, **options) -> dict[str, DataFrame]:
    """Every requested metric into a store below ``root``.

    ``window`` is a ``[start, end)`` as ``run_window`` gives it. ``locations`` holds the arguments of
    ``locations.update_locations`` but for the readings; each metric's readings then renew the
    location table, as far as they lie in the window.
    """
    if window is not None:
        options = {**options, "start": window[0], "end": window[1]}
    for spec in requested_metrics(names) if locations is not None else ():
        update_locations(spark, measurements=filter_time(source_of(spec), spec.time_column, options.get("start"), options.get("end")),
                         **locations)
    return {spec.name: run_metric(spark, spec, source_of(spec), f"{root}/{spec.name}", **options)
            for spec in requested_metrics(names)}


def measurement_matrix(spark: SparkSession, store: str, sensors: list[str] | None = None) -> DataFrame:
    return pivot_cells(read_store(spark, store), sensors)


def touched_periods(hour_cells: DataFrame) -> DataFrame:
    """Days, weeks, months, seasons and years that the hours fall in, per datasource."""
    at = F.col("date").cast("timestamp")
    levels = {"day": day_label, **LABELS}
    return (hour_cells.filter("type = 'hour'")
            .select("datasourceId", F.explode(F.array(*[
                F.struct(F.lit(t).alias("type"), label(at).alias("date")) for t, label in levels.items()])).alias("p"))
            .select("p.type", "p.date", "datasourceId").distinct())


def merge_hours(spark: SparkSession, hours: DataFrame, store: str, limits=None) -> None:
    """Merge hours of single sources (type, date, datasourceId, sourceId, value) and renew all they touch."""
    with versions.change(spark, store):
        merge_into_store(spark, hours, store, keys=SOURCE_CELL)
        refresh_periods(spark, store, hours, limits)


def refresh_periods(spark: SparkSession, store: str, hour_cells: DataFrame, limits=None) -> None:
    """Recompute from stored hours every period that ``hour_cells`` touch.

    Touched days come from their own hours. Longer periods come from the stored days
    of the touched years and of the months that their first winter and last week or winter
    reach into. Hours outside the touched days are not read.
    """
    limits = {**MIN_PARTS, **(limits or {})}
    touched = cut(touched_periods(hour_cells))
    days_touched = touched.filter("type = 'day'")
    dates = {r["date"] for r in days_touched.select("date").distinct().collect()}  # bounded by the calendar

    def stored(period_type: str, buckets: set[str]) -> DataFrame:
        cells = read_store(spark, store, {(period_type, b) for b in buckets}, SOURCE_CELL)
        of_touched = null_safe_join(cells, touched.select("datasourceId").distinct(), ["datasourceId"], "left_semi")
        return of_touched.select(*SENSOR, "date", F.col("value").alias("metric"), F.lit(True).alias("is_valid"))

    hours = cut(null_safe_join(stored("hour", dates).withColumn("_day", day_label(F.col("date").cast("timestamp"))),
                               days_touched.select("datasourceId", F.col("date").alias("_day")), ["datasourceId", "_day"], "left_semi"))
    days = keep_valid(label_days(rollup_day(hours.select(*SENSOR, F.col("date").cast("timestamp").alias("hour"), "metric", "is_valid"),
                                            limits["day"])))
    days = cut(source_cells(days, "metric"))
    merge_into_store(spark, days, store, replace=days_touched, keys=SOURCE_CELL)

    years = {int(d[:4]) for d in dates}
    around = {f"{y:04d}-{m:02d}" for y in years for m in range(1, 13)}
    around |= {f"{y - 1:04d}-12" for y in years} | {f"{y + 1:04d}-{m:02d}" for y in years for m in (1, 2)}
    all_days = stored("day", around).select(*SENSOR, F.col("date").cast("timestamp").alias("day"), "metric", "is_valid")
    upper = keep_valid(rollup_days(all_days, {t: limits[t] for t in LABELS}))
    upper = null_safe_join(upper, touched, CELL, "left_semi")
    # hours that were given may not be the ones that count: another source of the datasource may rank higher
    given = hour_cells.filter("type = 'hour'").select(*CELL).distinct()
    now = hours.select(*SENSOR, F.lit("hour").alias("type"), "date", "metric")
    now = null_safe_join(now, given, CELL, "left_semi").unionByName(days.select(*SOURCE_CELL, F.col("value").alias("metric")))
    cells = sensor_cells(now.unionByName(upper.select(*SOURCE_CELL, "metric")))
    merge_into_store(spark, cut(cells), store, replace=touched)
