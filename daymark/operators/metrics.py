"""The six daily metric tables as pure DataFrame functions.

Inputs are typed bronze frames:

* orders: order_id, user_id, amount, order_ts (timestamp)
* events: user_id, ts (timestamp) [, event_id, event_type]
* users:  user_id, channel

Semantics kept from the daily job: NULL user ids are not counted as buyers
or active users but their money is kept; a NULL day is its own group;
unmatched users fall under channel NULL; a duplicated user in the dimension
fans its revenue out over its channels (the ``unique`` rule guards this).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.money import MONEY_SCALE, minor_units, money_out
from daymark.functions.ratio import conversion_rate
from daymark.functions.temporal import day_of
from daymark.operators.joins import lookup_join

_MINOR = "_amount_minor"
MINOR_COLUMN = _MINOR


def _orders_by_day(orders: DataFrame, scale: int) -> DataFrame:
    return orders.select(
        day_of("order_ts").alias("order_date"),
        "order_id",
        "user_id",
        minor_units("amount", scale).alias(_MINOR),
    )


def _active_pairs(events: DataFrame) -> DataFrame:
    return events.select(day_of("ts").alias("event_date"), "user_id")


def daily_orders(orders: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    """Per day: distinct orders, distinct buyers, revenue."""
    return (
        _orders_by_day(orders, scale)
        .groupBy("order_date")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.countDistinct("user_id").alias("buyers"),
            money_out(F.sum(_MINOR), scale).alias("revenue"),
        )
    )


def distinct_orders_by_day(orders: DataFrame) -> DataFrame:
    """Per day: distinct order ids (one distinct count, no expand)."""
    return (
        orders.select(day_of("order_ts").alias("order_date"), "order_id")
        .groupBy("order_date")
        .agg(F.countDistinct("order_id").alias("orders"))
    )


def daily_orders_from(
    order_counts: DataFrame, per_user_minor: DataFrame, scale: int = MONEY_SCALE
) -> DataFrame:
    """daily_orders from distinct orders per day and a ``revenue_by_day_user``
    frame: buyers are its non-NULL users, revenue its sum.  Both sides hold
    the same days (the NULL day included, hence the null-safe join)."""
    per_day = per_user_minor.groupBy("order_date").agg(
        F.count("user_id").alias("buyers"), F.sum(_MINOR).alias(_MINOR)
    )
    joined = order_counts.join(
        per_day, order_counts["order_date"].eqNullSafe(per_day["order_date"]), "inner"
    )
    return joined.select(
        order_counts["order_date"],
        order_counts["orders"],
        per_day["buyers"],
        money_out(per_day[_MINOR], scale).alias("revenue"),
    )


def revenue_by_day_user(orders: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    """(order_date, user_id) → exact revenue in minor units; the map side combines."""
    return (
        _orders_by_day(orders, scale)
        .groupBy("order_date", "user_id")
        .agg(F.sum(_MINOR).alias(_MINOR))
    )


def daily_revenue(orders: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    """Per day and user: summed amount."""
    return daily_revenue_from_minor(revenue_by_day_user(orders, scale), scale)


def daily_revenue_from_minor(per_user: DataFrame, scale: int = MONEY_SCALE) -> DataFrame:
    """daily_revenue from a ``revenue_by_day_user`` frame (minor units)."""
    return per_user.select("order_date", "user_id", money_out(_MINOR, scale).alias("amount"))


def daily_buyers(orders: DataFrame) -> DataFrame:
    """Per day: distinct non-NULL buyers (only what conversion needs)."""
    return (
        orders.select(day_of("order_ts").alias("order_date"), "user_id")
        .groupBy("order_date")
        .agg(F.countDistinct("user_id").alias("buyers"))
    )


def daily_active_users(events: DataFrame) -> DataFrame:
    """Per day: distinct non-NULL users with any event."""
    return (
        _active_pairs(events)
        .groupBy("event_date")
        .agg(F.countDistinct("user_id").alias("dau"))
    )


def active_user_days(events: DataFrame) -> DataFrame:
    """Distinct (event_date, user_id) pairs, NULL user included."""
    return _active_pairs(events).distinct()


def daily_active_users_from_pairs(pairs: DataFrame) -> DataFrame:
    """daily_active_users from distinct (event_date, user_id) pairs."""
    return pairs.groupBy("event_date").agg(F.count("user_id").alias("dau"))


def daily_active_users_by_channel_from_pairs(
    pairs: DataFrame, users: DataFrame, broadcast_users: bool | None = None
) -> DataFrame:
    """Per day and channel from distinct (event_date, user_id) pairs."""
    joined = lookup_join(
        pairs, users.select("user_id", "channel"), "user_id", "left", broadcast_users
    )
    return joined.groupBy("event_date", "channel").agg(
        F.countDistinct("user_id").alias("dau")
    )


def daily_active_users_by_channel(
    events: DataFrame, users: DataFrame, broadcast_users: bool | None = None
) -> DataFrame:
    """Per day and channel: distinct active users.

    The join input is the distinct day × user set, so a user with many
    events is one row per day: no key can be hot on the join.
    """
    return daily_active_users_by_channel_from_pairs(
        active_user_days(events), users, broadcast_users
    )


def daily_revenue_by_channel(
    orders: DataFrame | None,
    users: DataFrame,
    scale: int = MONEY_SCALE,
    broadcast_users: bool | None = None,
    revenue: DataFrame | None = None,
    per_user_minor: DataFrame | None = None,
) -> DataFrame:
    """Per day and channel: revenue.

    Orders are first summed per (day, user) — exact for a sum, including the
    fan-out of a duplicated user — so the join sees one row per user-day and
    a hot user cannot skew it.  Instead of orders, ``revenue`` may be a
    written daily_revenue table (order_date, user_id, amount) and
    ``per_user_minor`` a written ``revenue_by_day_user`` frame.
    """
    if per_user_minor is not None:
        per_user = per_user_minor.select("order_date", "user_id", _MINOR)
    elif revenue is not None:
        per_user = revenue.select(
            "order_date", "user_id", minor_units("amount", scale).alias(_MINOR)
        )
    elif orders is not None:
        per_user = revenue_by_day_user(orders, scale)
    else:
        raise ValueError("need orders, a daily revenue table or per-user revenue")
    joined = lookup_join(
        per_user, users.select("user_id", "channel"), "user_id", "left", broadcast_users
    )
    return joined.groupBy("order_date", "channel").agg(
        money_out(F.sum(_MINOR), scale).alias("revenue")
    )


def buyers_from_revenue(revenue: DataFrame) -> DataFrame:
    """Per day: non-NULL buyers, from a daily_revenue table (one row per buyer)."""
    return revenue.groupBy("order_date").agg(F.count("user_id").alias("buyers"))


def conversion_from(dau: DataFrame, buyers: DataFrame, round_to: int | None = 4) -> DataFrame:
    """Join per-day dau (event_date, dau) with per-day buyers (order_date, buyers)."""
    joined = dau.join(buyers, dau["event_date"] == buyers["order_date"], "left")
    filled = F.coalesce(buyers["buyers"], F.lit(0).cast("long"))
    return joined.select(
        dau["event_date"].alias("date"),
        dau["dau"],
        filled.alias("buyers"),
        conversion_rate(filled, dau["dau"], round_to).alias("conv_rate"),
    )


def daily_conversion(
    events: DataFrame, orders: DataFrame, round_to: int | None = 4
) -> DataFrame:
    """Per active day: dau, buyers (0 if none), buyers / dau.

    Days without events are absent; the rate may exceed 1 because buyers
    need not be active.  Both sides hold one row per day, so the side Spark
    may broadcast is bounded by the number of distinct days; otherwise both
    are already hash-partitioned by day and the join adds no exchange.
    """
    return conversion_from(daily_active_users(events), daily_buyers(orders), round_to)
