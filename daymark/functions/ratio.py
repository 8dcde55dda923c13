"""Ratios that tolerate zero denominators under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def conversion_rate(
    buyers: str | Column, dau: str | Column, round_to: int | None = 4
) -> Column:
    """buyers / dau as DOUBLE; NULL when dau is 0; rounded unless round_to is None."""
    b = F.col(buyers) if isinstance(buyers, str) else buyers
    d = F.col(dau) if isinstance(dau, str) else dau
    rate = F.try_divide(b.cast("double"), d.cast("double"))
    return F.round(rate, round_to) if round_to is not None else rate
