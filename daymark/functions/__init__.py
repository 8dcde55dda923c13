"""Column-expression helpers (JVM-side built-ins only, no UDFs)."""

from daymark.functions.money import minor_units, money, money_out
from daymark.functions.ratio import conversion_rate
from daymark.functions.temporal import (
    day_of,
    lookback_bounds,
    on_day,
    parse_run_date,
    parse_timestamp,
    within_days,
)

__all__ = [
    "conversion_rate",
    "day_of",
    "lookback_bounds",
    "minor_units",
    "money",
    "money_out",
    "on_day",
    "parse_run_date",
    "parse_timestamp",
    "within_days",
]
