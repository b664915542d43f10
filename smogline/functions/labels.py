"""Period floors and the text labels of hours, days, weeks, months, seasons and years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.schema import TYPE_ORDER


def floor_hour(ts) -> Column:
    return F.date_trunc("hour", ts)


def floor_day(ts) -> Column:
    return F.date_trunc("day", ts)


def day_label(ts) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_label(ts) -> Column:
    """``yyyy-MM-dd HH:00:00``; midnight prints as the bare date."""
    start = floor_hour(ts)
    return F.when(F.hour(start) == 0, day_label(start)).otherwise(
        F.date_format(start, "yyyy-MM-dd HH:mm:ss"))


def iso_week_label(ts) -> Column:
    year = F.extract(F.lit("YEAROFWEEK"), ts).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def month_label(ts) -> Column:
    return F.date_format(ts, "yyyy-MM")


def season_of(ts) -> Column:
    month = F.month(ts)
    return (F.when(month.between(3, 5), "spring").when(month.between(6, 8), "summer")
            .when(month.between(9, 11), "autumn").when(month.isNotNull(), "winter"))


def season_label(ts) -> Column:
    """December counts towards the winter of the following year."""
    year = F.year(ts) + F.when(F.month(ts) == 12, 1).otherwise(0)
    return F.concat_ws("-", year.cast("string"), season_of(ts))


def year_label(ts) -> Column:
    return F.year(ts).cast("string")


LABELS = {"week": iso_week_label, "month": month_label, "season": season_label, "year": year_label}


def type_rank(type_col="type") -> Column:
    """0 for years up to 5 for hours; null for anything else."""
    position = F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), F.col(type_col))
    return F.when(position > 0, position - 1).cast("int")
