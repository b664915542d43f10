"""Cleaning steps from raw readings to valid periods, chosen by name in the metric spec."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from smogline.functions.times import parse_time
from smogline.functions.values import calibrate_pm25, nan_to_null, quoted
from smogline.operators.impute import qa_qc_impute
from smogline.operators.quality import drop_invalid_qc, filter_ranges, metric_as
from smogline.operators.rollup import rollup_all
from smogline.operators.series import drop_flatline, longest_series
from smogline.schema import HUMIDITY_RAW, PLAUSIBLE, PM25_CALIBRATED, PM25_RAW, MetricSpec
from smogline.session import cut

Cleaner = Callable[[DataFrame, MetricSpec], DataFrame]
CLEANERS: dict[str, Cleaner] = {}

MINUTE_MIN_OBS = 3


def register_cleaner(name: str, cleaner: Cleaner) -> None:
    CLEANERS[name] = cleaner


def clean_hourly(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """Drop invalid rows and roll the metric's column up to every level."""
    valid = drop_invalid_qc(df, spec)
    levels = rollup_all(valid, spec.time_column, spec.col_name, spec.min_obs_per_hour)
    return metric_as(levels, spec.name)


def prepare_minute_pm25(df: DataFrame, segment_rows: int | None = None) -> DataFrame:
    """Plausible, non-flat, gap-filled readings with parsed time and the calibrated column."""
    sized = {} if segment_rows is None else {"segment_rows": segment_rows}
    plausible = filter_ranges(df, PLAUSIBLE)
    if dict(plausible.dtypes)["time"] == "string":
        plausible = plausible.withColumn("time", parse_time("time"))
    # Written once: the missing share, the sensors and the filling all read it. A filter only
    # shortens series, so the length counted before serves all that follows.
    longest = longest_series(plausible)
    lively = cut(drop_flatline(plausible, "time", PM25_RAW, longest=longest, **sized))
    filled = qa_qc_impute(lively, "time", PM25_RAW, longest=longest, **sized)
    return filled.withColumn(PM25_CALIBRATED, calibrate_pm25(quoted(PM25_RAW), quoted(HUMIDITY_RAW)))


def clean_minute_pm25(df: DataFrame, spec: MetricSpec, col: str = PM25_RAW,
                      segment_rows: int | None = None) -> DataFrame:
    """Minute readings to valid periods; ``col`` chooses raw or calibrated values.

    An hour needs three readings whatever the spec says.
    """
    ready = prepare_minute_pm25(drop_invalid_qc(df, spec), segment_rows)
    return metric_as(rollup_all(ready, "time", col, MINUTE_MIN_OBS), spec.name)


register_cleaner("hourly", clean_hourly)
register_cleaner("minute_pm25", clean_minute_pm25)


def clean(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """Run the metric's cleaner; NaN counts as missing from here on."""
    if spec.cleaner not in CLEANERS:
        raise LookupError(f"no cleaner named {spec.cleaner!r}")
    missing = {c: nan_to_null(quoted(c)) for c, kind in df.dtypes if kind in ("double", "float")}
    return CLEANERS[spec.cleaner](df.withColumns(missing), spec)


__all__ = ["CLEANERS", "clean", "clean_hourly", "clean_minute_pm25", "prepare_minute_pm25",
           "register_cleaner"]
