"""Declared schemas: raw input contracts, bronze layout and metric outputs."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Raw orders file (orders_<yyyy-MM-dd>.csv): order_ts stays text until parsed.
ORDERS_RAW = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("order_ts", T.StringType(), True),
])

# Raw events file (events_<yyyy-MM-dd>.ndjson).  Nested values (props) are
# kept as JSON text; unparseable lines land in _corrupt_record.
EVENTS_RAW = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("ts", T.StringType(), True),
    T.StructField("props", T.StringType(), True),
])

# Users dimension (users.csv): the two columns the metrics read; other columns
# of a file (signup_date) are found by its header and left aside.
USERS_RAW = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("channel", T.StringType(), True),
])

# Typed bronze tables (what the metrics consume).
ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("order_ts", T.TimestampNTZType(), True),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("channel", T.StringType(), True),
])

# Silver outputs.
DAILY_ORDERS = T.StructType([
    T.StructField("order_date", T.DateType(), True),
    T.StructField("orders", T.LongType(), False),
    T.StructField("buyers", T.LongType(), False),
    T.StructField("revenue", T.DoubleType(), True),
])

DAILY_REVENUE = T.StructType([
    T.StructField("order_date", T.DateType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("amount", T.DoubleType(), True),
])

DAILY_ACTIVE_USERS = T.StructType([
    T.StructField("event_date", T.DateType(), True),
    T.StructField("dau", T.LongType(), False),
])

DAILY_ACTIVE_USERS_BY_CHANNEL = T.StructType([
    T.StructField("event_date", T.DateType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("dau", T.LongType(), False),
])

DAILY_REVENUE_BY_CHANNEL = T.StructType([
    T.StructField("order_date", T.DateType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("revenue", T.DoubleType(), True),
])

DAILY_CONVERSION = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("dau", T.LongType(), False),
    T.StructField("buyers", T.LongType(), False),
    T.StructField("conv_rate", T.DoubleType(), True),
])

OUTPUT_SCHEMAS: dict[str, T.StructType] = {
    "daily_orders": DAILY_ORDERS,
    "daily_revenue": DAILY_REVENUE,
    "daily_active_users": DAILY_ACTIVE_USERS,
    "daily_active_users_by_channel": DAILY_ACTIVE_USERS_BY_CHANNEL,
    "daily_revenue_by_channel": DAILY_REVENUE_BY_CHANNEL,
    "daily_conversion": DAILY_CONVERSION,
}
