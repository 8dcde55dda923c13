"""Timestamps, dates and run-date predicates."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_run_date(value: str | dt.date | dt.datetime | None) -> dt.date | None:
    """Validate a run date on the driver (``YYYY-MM-DD`` or a date)."""
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    try:
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
            raise ValueError("not YYYY-MM-DD")
        return dt.date.fromisoformat(text)
    except ValueError as exc:
        raise ValueError(f"run date must be YYYY-MM-DD, got {value!r}") from exc


# Fixed value: a time of day with a zone behind it (Z, UTC, +hh:mm, +hhmm, +hh, Region/City).
ZONE_SUFFIX = r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*([zZ]|UTC|GMT|[+-]\d{2}(:?\d{2})?|[A-Z]\w+(/[\w+-]+)+)$"


def parse_timestamp(col: str | Column, data_type: T.DataType | None = None) -> Column:
    """Text → wall-clock TIMESTAMP_NTZ; junk becomes NULL instead of failing.

    Text without a zone is taken as written (no time-zone arithmetic, so no
    DST gap can move it); text with an offset is converted to the session
    time zone's wall clock.  Timestamp input passes through.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(data_type, T.TimestampNTZType):
        return c
    if isinstance(data_type, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    text = F.trim(c)
    zoned = F.regexp_replace(text, "z$", "Z")
    return F.when(
        text.rlike(ZONE_SUFFIX), zoned.try_cast("timestamp").cast("timestamp_ntz")
    ).otherwise(text.try_cast("timestamp_ntz"))


def day_of(col: str | Column) -> Column:
    """Calendar day of a timestamp (session time zone for LTZ input)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(c)


def on_day(col: str | Column, run_date: dt.date) -> Column:
    """``to_date(ts) = run_date``; Catalyst turns it into a pushed range."""
    return day_of(col) == F.lit(run_date)


def lookback_bounds(run_date: dt.date, days_back: int) -> tuple[dt.date, dt.date]:
    """Inclusive window ``[run_date - (days_back - 1), run_date]``."""
    if days_back < 1:
        raise ValueError("days_back must be >= 1")
    return run_date - dt.timedelta(days=days_back - 1), run_date


def within_days(col: str | Column, run_date: dt.date, days_back: int) -> Column:
    first, last = lookback_bounds(run_date, days_back)
    d = day_of(col)
    return (d >= F.lit(first)) & (d <= F.lit(last))


def on_days(col: str | Column, days: Sequence[dt.date]) -> Column:
    """The calendar day is one of ``days``; their range reaches the scan."""
    d = day_of(col)
    days = sorted(set(days))
    if not days:
        return F.lit(False)
    inside = (d >= F.lit(days[0])) & (d <= F.lit(days[-1]))
    if len(days) == (days[-1] - days[0]).days + 1:
        return inside
    return inside & d.isin(*days)
