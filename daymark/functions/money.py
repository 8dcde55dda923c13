"""Money: exact integer sums of minor units inside, DOUBLE at the boundary.

Each amount is first rounded to DECIMAL(18, scale) (HALF_UP, like a decimal
cast) and then taken as a LONG count of minor units (cents for scale 2).
Sums of LONGs are exact, do not depend on row order, and keep a fixed-width
aggregation buffer — a DECIMAL(28, 2) sum buffer is stored as bytes and is
markedly slower.  A LONG holds about 9.2e16 minor units per group; ANSI mode
raises on overflow rather than wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_PRECISION = 18
MONEY_SCALE = 2


def money(col: str | Column, scale: int = MONEY_SCALE) -> Column:
    """Amount as DECIMAL(18, scale)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(f"decimal({MONEY_PRECISION},{scale})")


def minor_units(col: str | Column, scale: int = MONEY_SCALE) -> Column:
    """Amount as a LONG number of minor units (exact, rounded HALF_UP)."""
    return (money(col, scale) * F.lit(10**scale)).cast("long")


def money_out(minor: str | Column, scale: int = MONEY_SCALE) -> Column:
    """Minor units → amount as a DOUBLE rounded to ``scale`` places."""
    c = F.col(minor) if isinstance(minor, str) else minor
    return F.round(c / F.lit(float(10**scale)), scale)
