"""The daily build: run-date selection and the six metric DataFrames."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from daymark.functions.money import MONEY_SCALE
from daymark.functions.temporal import on_day, parse_run_date, within_days
from daymark.operators import metrics as M
from daymark.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast


def restrict_days(
    df: DataFrame,
    ts_col: str,
    run_date: str | dt.date | None = None,
    days_back: int = 1,
) -> DataFrame:
    """Rows whose day is the run date (or the ``days_back`` window ending on it).

    No run date → every row, NULL days included.  The row's own date decides,
    never the file it came from, so a late row is not lost.
    """
    day = parse_run_date(run_date)
    if day is None:
        return df
    if days_back == 1:
        return df.where(on_day(ts_col, day))
    return df.where(within_days(ts_col, day, days_back))


@dataclass(frozen=True)
class MetricTable:
    name: str
    df: DataFrame
    partition_col: str
    layout: str = "cluster"
    tie_cols: tuple[str, ...] = ()


# Partition column and warehouse table of each output (fixed names).
PARTITION_COLUMNS = {
    "daily_orders": "order_date",
    "daily_revenue": "order_date",
    "daily_active_users": "event_date",
    "daily_active_users_by_channel": "event_date",
    "daily_revenue_by_channel": "order_date",
    "daily_conversion": "date",
}

# Write layout: ranges of days per task.  Rows per day are bounded (one, or
# one per channel) except for daily_revenue (one per buyer), whose range
# bounds also use user_id so a hot day is split over several tasks.
LAYOUTS = {name: "cluster" for name in PARTITION_COLUMNS}
TIE_COLUMNS = {"daily_revenue": ("user_id",)}

WAREHOUSE_TABLES = {
    "daily_orders": "fact_daily_orders",
    "daily_revenue": "fact_daily_revenue",
    "daily_active_users": "fact_daily_active_users",
    "daily_active_users_by_channel": "agg_dau_by_channel",
    "daily_revenue_by_channel": "agg_revenue_by_channel",
    "daily_conversion": "agg_daily_conversion",
}


def build_metric_tables(
    orders: DataFrame,
    events: DataFrame,
    users: DataFrame,
    run_date: str | dt.date | None = None,
    days_back: int = 1,
    scale: int = MONEY_SCALE,
    round_to: int | None = 4,
    broadcast_users: bool | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> dict[str, MetricTable]:
    """All six tables, lazily.  The users size check runs once here."""
    orders = restrict_days(orders, "order_ts", run_date, days_back)
    events = restrict_days(events, "ts", run_date, days_back)
    users = users.select("user_id", "channel")
    if broadcast_users is None:
        broadcast_users = fits_broadcast(users, max_broadcast_rows)
    frames = {
        "daily_orders": M.daily_orders(orders, scale),
        "daily_revenue": M.daily_revenue(orders, scale),
        "daily_active_users": M.daily_active_users(events),
        "daily_active_users_by_channel": M.daily_active_users_by_channel(
            events, users, broadcast_users
        ),
        "daily_revenue_by_channel": M.daily_revenue_by_channel(
            orders, users, scale, broadcast_users
        ),
        "daily_conversion": M.daily_conversion(events, orders, round_to),
    }
    return {
        name: MetricTable(
            name, df, PARTITION_COLUMNS[name], LAYOUTS[name], TIE_COLUMNS.get(name, ())
        )
        for name, df in frames.items()
    }
