"""Time parsing, formatting and period bounds."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.functions.labels import season_of

PERIOD_KINDS = ("3hours", "day", "week", "month", "season", "year")


def parse_time(text) -> Column:
    """ISO text to timestamp; text that is no time becomes null."""
    return F.try_to_timestamp(text if isinstance(text, Column) else F.col(text))


def format_iso(ts) -> Column:
    """``2026-01-01T00:00:00.000Z``; fractions of a second are cut off."""
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss'.000Z'")


def _add_months(day: datetime, months: int) -> datetime:
    index = day.year * 12 + day.month - 1 + months
    return day.replace(year=index // 12, month=index % 12 + 1, day=1)


def period_bounds(kind: str, which: str, now: datetime) -> tuple[datetime, datetime]:
    """Half-open ``[start, end)`` of the current or previous period around ``now``.

    The current "3hours" are the last three full hours, the previous ones the three before.
    """
    if which not in ("current", "previous"):
        raise ValueError(f"unknown period choice: {which}")
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    first = midnight.replace(day=1)
    if kind == "3hours":
        end = now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=3 * (which == "previous"))
        return end - timedelta(hours=3), end
    if kind in ("day", "week"):
        length = timedelta(days=1 if kind == "day" else 7)
        start = midnight if kind == "day" else midnight - timedelta(days=midnight.weekday())
        return (start, start + length) if which == "current" else (start - length, start)
    months = {"month": 1, "season": 3, "year": 12}.get(kind)
    if months is None:
        raise ValueError(f"unknown period kind: {kind}")
    start = {"month": first, "season": _add_months(first, -(now.month % 3)),
             "year": first.replace(month=1)}[kind]
    return ((start, _add_months(start, months)) if which == "current"
            else (_add_months(start, -months), start))


#: What a historical run can be asked for, from the smallest to the largest, and the window that gives.
RUN_WINDOWS = {
    "hour": ("3hours", "current"), "day": ("day", "previous"), "week": ("week", "previous"), "month": ("month", "previous"),
    "season": ("season", "previous"), "year": ("year", "previous"),
}


def run_window(now: datetime, historical: bool = False, levels=(), start: datetime | None = None,
               end: datetime | None = None) -> tuple[datetime, datetime | None]:
    """The ``[start, end)`` of a run; an end of None is open.

    A recent run starts at ``start`` or else with the current three hours and is open. A
    historical one covers the largest of the named ``levels``; without any, ``start`` to ``end``,
    either of which defaults to that of the previous month. Levels and times exclude each other.
    """
    unknown = sorted(set(levels) - set(RUN_WINDOWS))
    if unknown:
        raise ValueError(f"unknown levels: {unknown}")
    if levels and (start or end):
        raise ValueError("give either levels or times")
    if not historical:
        if levels:
            raise ValueError("levels belong to a historical run")
        return start or period_bounds("3hours", "current", now)[0], end
    if levels:
        return period_bounds(*RUN_WINDOWS[max(levels, key=list(RUN_WINDOWS).index)], now)
    default = period_bounds("month", "previous", now)
    return start or default[0], end or default[1]


def season_bounds(now: datetime) -> tuple[datetime, datetime]:
    return period_bounds("season", "current", now)


def period_start(kind: str, ts, shift: int = 0) -> Column:
    """First instant of the period ``shift`` periods away from the one holding ``ts``."""
    ts = ts if isinstance(ts, Column) else F.col(ts)
    if kind in ("day", "week"):
        days = shift * (1 if kind == "day" else 7)
        return F.date_add(F.date_trunc(kind, ts).cast("date"), days).cast("timestamp")
    months = {"month": 1, "season": 3, "year": 12}[kind]
    first = F.trunc(ts, "year" if kind == "year" else "month")
    if kind == "season":
        first = F.add_months(first, -(F.month(ts) % 3))
    return F.add_months(first, shift * months).cast("timestamp")


__all__ = ["PERIOD_KINDS", "format_iso", "parse_time", "period_bounds", "period_start", "RUN_WINDOWS",
           "run_window", "season_bounds", "season_of"]
