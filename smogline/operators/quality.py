"""Projections, filters and quality counts."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.functions.times import parse_time
from smogline.functions.values import nan_to_null, present, qc_column_for, quoted
from smogline.schema import SENSOR, MetricSpec

# Suffixes that mark a column as part of a metric.
METRIC_SUFFIXES = (".value", ".raw", ".calibrated", ".status", ".qcAssessment", ".qcFlags")


def metric_of(column: str) -> str | None:
    for suffix in METRIC_SUFFIXES:
        if column.endswith(suffix):
            return column[: -len(suffix)]
    return None


def select_metrics(df: DataFrame, pattern: str | None, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Keep the id columns and the metrics named by ``only <term> + <term>``.

    A term is a glob over metric names or ``:group``; what a group holds (again
    globs) is given by ``groups``. Without a pattern every column stays.
    """
    if not pattern:
        return df
    words = pattern.split(None, 1)
    if words[0] != "only" or len(words) < 2:
        raise ValueError(f"not a metric selection: {pattern!r}")
    globs = []
    for term in (t.strip() for t in words[1].split("+")):
        if term.startswith(":"):
            if term[1:] not in (groups or {}):
                raise ValueError(f"unknown metric group {term!r}")
            globs += groups[term[1:]]
        elif term:
            globs.append(term)

    def wanted(column: str) -> bool:
        metric = metric_of(column)
        return metric is None or any(
            fnmatch.fnmatchcase(metric.lower(), g.lower()) for g in globs)

    return df.select(*[quoted(c) for c in df.columns if wanted(c)])


def filter_time(df: DataFrame, ts_col: str, start=None, end=None) -> DataFrame:
    """Rows in ``[start, end)``; literals, so the filter reaches the scan. Text is parsed."""
    ts = parse_time(quoted(ts_col)) if dict(df.dtypes)[ts_col] == "string" else quoted(ts_col)
    if start is not None:
        df = df.filter(ts >= F.lit(start))
    if end is not None:
        df = df.filter(ts < F.lit(end))
    return df


def drop_invalid_qc(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """Drop rows assessed as invalid; rows without an assessment stay."""
    if not spec.drops_invalid:
        return df
    return df.filter(~quoted(qc_column_for(spec.col_name)).eqNullSafe(F.lit("invalid")))


def filter_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose values lie in their ranges; a missing value, null or NaN, stays."""
    for name, (low, high) in ranges.items():
        value = nan_to_null(quoted(name).cast("double"))
        df = df.filter(value.isNull() | value.between(low, high))
    return df


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Apply the renames whose column is present; two columns must not end up with one name."""
    present = {a: b for a, b in mapping.items() if a in df.columns}
    names = [present.get(c, c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"renaming gives more than one column named {twice}")
    return df.withColumnsRenamed(present)


def metric_as(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnRenamed("metric", name)


def flag_valid(df: DataFrame, is_valid: Column) -> DataFrame:
    return df.withColumn("is_valid", is_valid)


def keep_valid(df: DataFrame) -> DataFrame:
    return df.filter("is_valid")


def drop_missing(df: DataFrame, col: str) -> DataFrame:
    return df.filter(present(col).isNotNull()).withColumn("impute_flag", F.lit("drop_na_lt5"))


def missing_rate(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(present(col).isNull().cast("double")).alias("missing_rate"))


def flag_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("impute_flag").agg(F.count("*").alias("n"))


def completeness(hours: DataFrame, keys=SENSOR) -> DataFrame:
    """Observed hours, valid hours and their share per sensor."""
    total, valid = F.count("*"), F.count_if("is_valid")
    return hours.groupBy(*keys).agg(
        total.alias("hours_total"), valid.alias("hours_valid"),
        (F.lit(100.0) * valid / F.greatest(total, F.lit(1))).alias("pct_valid"))


def validity_summary(levels: DataFrame) -> DataFrame:
    """Rows before and after the validity filter, per period type."""
    return levels.groupBy("type").agg(
        F.count("*").alias("rows_all"), F.count_if("is_valid").alias("rows_valid"))
