"""Calibration, relative difference, text masking and column naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def present(name: str) -> Column:
    """A column by its name, which may hold dots, with NaN as null."""
    return nan_to_null(quoted(name))


def calibrate_pm25(raw, humidity) -> Column:
    """Fine-dust reading corrected for relative humidity, by concentration range.

    The coefficients are fixed values. The high range does not use humidity.
    """
    raw, humidity = _col(raw), _col(humidity)
    low = F.lit(0.524) * raw - F.lit(0.0862) * humidity + F.lit(5.75)
    high = F.lit(0.46) * raw + F.lit(0.000393) * raw * raw + F.lit(2.97)
    return F.when(raw < 343, low).when(raw >= 343, high)


def rel_diff(a, b) -> Column:
    """``|a - b| / |b|``; null when either is missing or ``b`` is zero."""
    a, b = _col(a), _col(b)
    return F.try_divide(F.abs(a - b), F.abs(b))


def mask_text(text, limit: int = 20) -> Column:
    text = _col(text)
    return F.when(F.length(text) > limit,
                  F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def qc_column_for(value_column: str) -> str:
    """``x.value`` -> ``x.qcAssessment``."""
    return value_column.replace(".value", ".qcAssessment")


def quoted(name: str) -> Column:
    """A column whose name may hold dots."""
    return F.col(f"`{name}`")
