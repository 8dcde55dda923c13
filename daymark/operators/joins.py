"""Fact ⋈ dimension joins with a checked broadcast decision.

A dimension is broadcast only when its rows and their bytes — measured, not
estimated from file sizes — are within bounds; otherwise the join is a shuffle
sort-merge join and AQE's skew-join handling splits hot partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes of a dimension that may be shipped to every executor: 2M rows
# of (LONG, short STRING) are a few tens of MB once hashed.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 128 << 20
_FIXED_WIDTH = 16


def _row_bytes(dim: DataFrame) -> Column:
    """A row's bytes: texts as they are, other values at a fixed width."""
    wide = [f.name for f in dim.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in wide]
    return reduce(lambda a, b: a + b, texts, F.lit(_FIXED_WIDTH * len(dim.columns)).cast("long"))


def fits_broadcast(
    dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> bool:
    """Count the dimension's rows and bytes (one job, where it is read) and compare them with the bounds."""
    size = dim.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_row_bytes(dim)), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def prepare_dimension(
    dim: DataFrame,
    broadcast: bool | None = None,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Tag a dimension with the join strategy to use.

    ``broadcast=None`` measures the dimension; ``True``/``False`` is a decision
    the caller already made (the job measures once and reuses it).
    """
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_rows)
    return F.broadcast(dim) if broadcast else dim.hint("shuffle_merge")


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "left",
    broadcast: bool | None = None,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``facts ⟕ dim`` on ``on`` with a checked strategy for the dimension."""
    return facts.join(prepare_dimension(dim, broadcast, max_rows), on=on, how=how)
