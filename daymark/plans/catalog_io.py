"""Registered round trips: scans, ingest, sinks, publish and the job.

Each query writes to a fresh folder under the shared checkpoint root,
derived from the given tables, and returns a lazy read of what was written.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import schemas as S
from daymark.operators import key_index as K
from daymark.operators import metrics as M
from daymark.operators import quality as DQ
from daymark.plans import bronze as B
from daymark.plans import incremental as I
from daymark.plans import staging as ST
from daymark.plans.catalog import (
    _SQL_ORDERS,
    _SQL_PURCHASES,
    _SQL_USERS,
    ORACLE_SQL,
    _money,
    _sql_conversion,
    _sql_daily_orders,
    register,
)
from daymark.plans.daily import (
    LAYOUTS,
    PARTITION_COLUMNS,
    TIE_COLUMNS,
    WAREHOUSE_TABLES,
    build_metric_tables,
    restrict_days,
)
from daymark.plans.job import JobPaths, run_daily_job, write_metric_tables
from daymark.plans.maintenance import compact_bronze, vacuum_bronze
from daymark.plans.replay import replay_quarantine
from daymark.session import shared_dir
from daymark.sinks import files as SK
from daymark.sinks import warehouse as WH
from daymark.sinks.snapshots import SnapshotStore
from daymark.sources import tables as TB
from daymark.sources.csv import read_orders_csv, read_users_csv
from daymark.sources.files import join_uri, with_provenance
from daymark.sources.ndjson import read_ndjson, typed_events

_SQL_SCAN_ORDERS = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, "
    "o_totalprice AS amount, o_orderdate AS order_ts FROM orders"
)
_SQL_SCAN_PURCHASES = (
    "SELECT CAST(event_id AS VARCHAR) AS order_id, user_id, value AS amount, ts AS order_ts "
    "FROM events WHERE event_type = 'purchase'"
)
_SQL_EVENTS = "SELECT event_id, user_id, event_type, ts FROM events"

_ORDER_COLS = ("order_id", "user_id", "amount", "order_ts")
_EVENT_COLS = ("event_id", "user_id", "event_type", "ts")


# ---------------------------------------------------------------------------
# S1-S5: scans.
# ---------------------------------------------------------------------------

@register("scan_csv_orders", _SQL_SCAN_ORDERS)
def q_scan_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "scan_csv_orders")
    path = ST.stage_orders_csv(spark, sf_dir, root)
    return read_orders_csv(spark, path).select(*_ORDER_COLS)


@register("scan_csv_users", _SQL_USERS)
def q_scan_csv_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "scan_csv_users")
    return read_users_csv(spark, ST.stage_users_csv(spark, sf_dir, root))


@register("scan_ndjson_events", _SQL_EVENTS)
def q_scan_ndjson_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "scan_ndjson_events")
    path = ST.stage_events_ndjson(spark, sf_dir, root)
    raw = read_ndjson(spark, path, recursive=True, name_glob="*.json")
    return typed_events(raw).select(*_EVENT_COLS)


@register(
    "raw_file_manifest",
    "SELECT CAST(ts AS DATE) AS file_date, count(*) AS rows FROM events GROUP BY 1",
)
def q_raw_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per raw file, rolled up to the date each file carries."""
    root = shared_dir(spark, "raw_file_manifest")
    path = ST.stage_events_ndjson(spark, sf_dir, root)
    raw = with_provenance(read_ndjson(spark, path, recursive=True, name_glob="*.json"))
    per_file = raw.groupBy("source_file", "file_date").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy("file_date").agg(F.sum("rows").alias("rows"))


@register("concat_order_files", f"{_SQL_SCAN_ORDERS}\nUNION ALL\n{_SQL_SCAN_PURCHASES}")
def q_concat_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan over two folders of order files (UNION ALL by name)."""
    root = shared_dir(spark, "concat_order_files")
    a = ST.stage_orders_csv(spark, sf_dir, root)
    b = ST.stage_orders_csv(spark, sf_dir, root, purchases=True)
    return read_orders_csv(spark, [a, b]).select(*_ORDER_COLS)


# ---------------------------------------------------------------------------
# K8, K9: raw → bronze.
# ---------------------------------------------------------------------------

@register("bronze_orders", _SQL_SCAN_ORDERS)
def q_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "bronze_orders")
    raw = ST.stage_orders_csv(spark, sf_dir, root)
    bronze = join_uri(root, "bronze")
    B.ingest_orders(spark, raw, bronze, name_glob="*.csv")
    return B.read_bronze_orders(spark, bronze).select(*_ORDER_COLS)


@register("bronze_events", _SQL_EVENTS)
def q_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "bronze_events")
    raw = ST.stage_events_ndjson(spark, sf_dir, root)
    bronze = join_uri(root, "bronze")
    B.ingest_events(spark, raw, bronze, name_glob="*.json")
    return B.read_bronze_events(spark, bronze).select(*_EVENT_COLS)


# ---------------------------------------------------------------------------
# K1-K7: sinks.
# ---------------------------------------------------------------------------

_SQL_DAU_CH = ORACLE_SQL["daily_active_users_by_channel"]


@register("sink_csv_partitioned", _SQL_DAU_CH)
def q_sink_csv_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "sink_csv_partitioned")
    df = M.daily_active_users_by_channel(
        TB.events_table(spark, sf_dir), TB.users_table(spark, sf_dir)
    )
    SK.write_partitioned(df, path, ["event_date"], fmt="csv", stringify=True)
    return SK.read_back(spark, path, S.DAILY_ACTIVE_USERS_BY_CHANNEL, fmt="csv")


SINK_RUN_DATE = "2024-01-15"


@register("sink_parquet_dynamic", _sql_daily_orders(_SQL_PURCHASES))
def q_sink_parquet_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every day, rewrite one run date: the other days must survive."""
    path = shared_dir(spark, "sink_parquet_dynamic")
    purchases = TB.purchases_table(spark, sf_dir)
    SK.write_partitioned(M.daily_orders(purchases), path, ["order_date"])
    one_day = M.daily_orders(restrict_days(purchases, "order_ts", SINK_RUN_DATE))
    SK.write_partitioned(one_day, path, ["order_date"], dynamic=True)
    return SK.read_back(spark, path, S.DAILY_ORDERS)


@register("sink_csv_flat", ORACLE_SQL["daily_revenue_by_channel"])
def q_sink_csv_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "sink_csv_flat")
    df = M.daily_revenue_by_channel(TB.orders_table(spark, sf_dir), TB.users_table(spark, sf_dir))
    SK.write_flat(df, path, fmt="csv")
    return SK.read_back(spark, path, S.DAILY_REVENUE_BY_CHANNEL, fmt="csv")


@register("sink_parquet_plain", ORACLE_SQL["daily_revenue"])
def q_sink_parquet_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "sink_parquet_plain")
    SK.write_flat(M.daily_revenue(TB.orders_table(spark, sf_dir)), path, fmt="parquet")
    return SK.read_back(spark, path, S.DAILY_REVENUE)


@register("sink_warehouse_refresh", ORACLE_SQL["daily_active_users"])
def q_sink_warehouse_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh of a catalog table, twice: the second replaces the first."""
    path = shared_dir(spark, "sink_warehouse_refresh")
    table = "fact_daily_active_users_" + path.rsplit("-", 1)[-1]
    events = TB.events_table(spark, sf_dir)
    first_day = restrict_days(events, "ts", "2024-01-01")
    WH.refresh_catalog_table(spark, M.daily_active_users(first_day), table, path)
    return WH.refresh_catalog_table(spark, M.daily_active_users(events), table, path)


# ---------------------------------------------------------------------------
# K6, Q7, G1, G5, A8: publish, gate and the job.
# ---------------------------------------------------------------------------

def _sql_count(name: str, sql: str, column: str = "rows_written") -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS {column} FROM ({sql}) t"


_SQL_PURCHASE_TABLES = {
    "daily_orders": _sql_daily_orders(_SQL_PURCHASES),
    "daily_revenue": f"SELECT CAST(order_ts AS DATE) AS order_date, user_id, {_money('amount')} AS amount FROM ({_SQL_PURCHASES}) o GROUP BY 1, 2",
    "daily_active_users": ORACLE_SQL["daily_active_users"],
    "daily_active_users_by_channel": _SQL_DAU_CH,
    "daily_revenue_by_channel": f"""
SELECT CAST(o.order_ts AS DATE) AS order_date, u.channel, {_money('o.amount')} AS revenue
FROM ({_SQL_PURCHASES}) o LEFT JOIN ({_SQL_USERS}) u ON o.user_id = u.user_id GROUP BY 1, 2""",
    "daily_conversion": _sql_conversion(_SQL_PURCHASES, rounded=True),
}

_SQL_ORDER_TABLES = {
    "daily_orders": ORACLE_SQL["daily_orders"],
    "daily_revenue": ORACLE_SQL["daily_revenue"],
    "daily_active_users": ORACLE_SQL["daily_active_users"],
    "daily_active_users_by_channel": _SQL_DAU_CH,
    "daily_revenue_by_channel": ORACLE_SQL["daily_revenue_by_channel"],
    "daily_conversion": ORACLE_SQL["daily_conversion"],
}


def _counts_sql(column: str, extra: str = "", tables: dict[str, str] = _SQL_PURCHASE_TABLES) -> str:
    parts = [_sql_count(n, s, column) for n, s in tables.items()]
    return f"SELECT table_name, {column}{extra} FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) c"


@register("publish_tables", _counts_sql("rows_written", ", true AS ok"))
def q_publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "publish_tables")
    tables = build_metric_tables(
        TB.purchases_table(spark, sf_dir), TB.events_table(spark, sf_dir), TB.users_table(spark, sf_dir)
    )
    silver = join_uri(root, "silver")
    for name, t in tables.items():
        SK.write_partitioned(
            t.df, join_uri(silver, name), [t.partition_col], count_rows=False,
            layout=t.layout, tie_cols=t.tie_cols,
        )
    written = {name: spark.read.parquet(join_uri(silver, name)) for name in tables}
    layouts = {n: (LAYOUTS[n], TIE_COLUMNS.get(n, ())) for n in tables}
    outcomes = WH.publish(
        written, join_uri(root, "published"), PARTITION_COLUMNS, layouts=layouts
    )
    return WH.outcomes_frame(spark, outcomes).select("table_name", "rows_written", "ok")


#: The job's rules for purchases made of events: one without a positive value is counted by the SQL, so it is
#: reported and quarantined but does not stop the run.  The other rules do.
PURCHASE_RULES = tuple(replace(r, severity="warn") if r.check == "gt_zero" else r for r in DQ.DEFAULT_RULES)


@register("gated_publish", ORACLE_SQL["daily_conversion_purchases"])
def q_gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate the job's rules on the inputs, then publish daily_conversion."""
    root = shared_dir(spark, "gated_publish")
    orders = TB.purchases_table(spark, sf_dir)
    users = TB.users_table(spark, sf_dir)
    DQ.gate(DQ.rule_summary({"orders": orders, "users": users}, PURCHASE_RULES), PURCHASE_RULES)
    conv = M.daily_conversion(TB.events_table(spark, sf_dir), orders)
    out = join_uri(root, "daily_conversion")
    WH.publish({"daily_conversion": conv}, root, {"daily_conversion": "date"}, layouts=LAYOUTS)
    return SK.read_back(spark, out, S.DAILY_CONVERSION)


def _staged_job(spark: SparkSession, sf_dir: str, key: str, **job_args):
    root = shared_dir(spark, key)
    orders = ST.stage_orders_csv(spark, sf_dir, root)
    events = ST.stage_events_ndjson(spark, sf_dir, root)
    users = ST.stage_users_csv(spark, sf_dir, root)
    paths = JobPaths(
        raw_orders=orders, raw_events=events, bronze=join_uri(root, "bronze"),
        silver=join_uri(root, "silver"), users=join_uri(users, "*.csv"),
    )
    return run_daily_job(
        spark, paths, raw_orders_glob="*.csv", raw_events_glob="*.json", **job_args
    )


@register("stage_metrics", _counts_sql("rows"))
def q_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per silver table, counted by Observations on the writes."""
    root = shared_dir(spark, "stage_metrics")
    tables = build_metric_tables(
        TB.purchases_table(spark, sf_dir), TB.events_table(spark, sf_dir),
        TB.users_table(spark, sf_dir),
    )
    paths = JobPaths(bronze=join_uri(root, "bronze"), silver=join_uri(root, "silver"), users="")
    written = write_metric_tables(tables, paths)
    rows = [(name, res.rows) for name, res in written.items()]
    return spark.createDataFrame(rows, "table_name string, rows bigint")


_SQL_JOB_DQ_VIOLATIONS = f"""
(SELECT count(*) FILTER (WHERE order_id IS NULL) + count(*) FILTER (WHERE amount <= 0) FROM ({_SQL_ORDERS}) o)
+ (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
   FROM (SELECT user_id, count(*) AS n FROM ({_SQL_USERS}) u GROUP BY 1) g)"""

_SQL_JOB_SUMMARY = f"""
SELECT 'ingest' AS stage, 'orders' AS table_name, count(*) AS rows FROM orders
UNION ALL SELECT 'ingest', 'events', count(*) FROM events
UNION ALL SELECT 'quality', 'quarantine', {_SQL_JOB_DQ_VIOLATIONS}
UNION ALL SELECT 'quality', 'gate', 2 * (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
UNION ALL SELECT 'transform', 'revenue_by_day_user', count(*) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE), o_custkey FROM orders) r
UNION ALL SELECT 'transform', 'active_user_days', count(*) FROM (SELECT DISTINCT CAST(ts AS DATE), user_id FROM events) p
UNION ALL SELECT 'transform', table_name, rows FROM ({_counts_sql("rows", tables=_SQL_ORDER_TABLES)}) t"""


@register("daily_job_summary", _SQL_JOB_SUMMARY)
def q_daily_job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage record of an end-to-end run (ingest, quality, transform)."""
    result = _staged_job(spark, sf_dir, "daily_job_summary")
    return result.stages_frame(spark).select("stage", "table_name", "rows")


# ---------------------------------------------------------------------------
# Incremental ingest (Structured Streaming, availableNow).
# ---------------------------------------------------------------------------

from daymark.streaming.ingest import ingest_stream  # noqa: E402


@register("stream_bronze_orders", _SQL_SCAN_ORDERS)
def q_stream_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order files → bronze by a file-source stream run to completion."""
    root = shared_dir(spark, "stream_bronze_orders")
    raw = ST.stage_orders_csv(spark, sf_dir, root)
    bronze = join_uri(root, "bronze")
    ingest_stream(spark, "orders", raw, bronze, name_glob="*.csv")
    return B.read_bronze_orders(spark, bronze).select(*_ORDER_COLS)


@register("stream_bronze_events", _SQL_EVENTS)
def q_stream_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream_bronze_events")
    raw = ST.stage_events_ndjson(spark, sf_dir, root)
    bronze = join_uri(root, "bronze")
    ingest_stream(spark, "events", raw, bronze, name_glob="*.json")
    return B.read_bronze_events(spark, bronze).select(*_EVENT_COLS)


# ---------------------------------------------------------------------------
# P4: run-date pruning of bronze by the date each raw file carries.
# ---------------------------------------------------------------------------

BRONZE_RUN_DATE = "2024-01-15"


@register(
    "bronze_events_run_date",
    f"{_SQL_EVENTS} WHERE CAST(ts AS DATE) = DATE '{BRONZE_RUN_DATE}'",
)
def q_bronze_events_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the run date's bronze partitions are read (file_date pruning),
    then the row date decides."""
    root = shared_dir(spark, "bronze_events_run_date")
    raw = ST.stage_events_ndjson(spark, sf_dir, root)
    bronze = join_uri(root, "bronze")
    B.ingest_events(spark, raw, bronze, name_glob="*.json")
    events = B.read_bronze_events(spark, bronze, BRONZE_RUN_DATE)
    return restrict_days(events, "ts", BRONZE_RUN_DATE).select(*_EVENT_COLS)


# ---------------------------------------------------------------------------
# G2 + G3 inside the job: one run date with a look-back window.
# ---------------------------------------------------------------------------

JOB_RUN_DATE = "2024-01-15"
JOB_DAYS_BACK = 7
_IN_WINDOW = (
    f"BETWEEN DATE '{JOB_RUN_DATE}' - INTERVAL {JOB_DAYS_BACK - 1} DAY AND DATE '{JOB_RUN_DATE}'"
)
_SQL_WIN_ORDERS = f"SELECT * FROM ({_SQL_PURCHASES}) o WHERE CAST(order_ts AS DATE) {_IN_WINDOW}"
_SQL_WIN_EVENTS = f"SELECT * FROM events WHERE CAST(ts AS DATE) {_IN_WINDOW}"
_SQL_WIN_PAIRS = f"SELECT DISTINCT CAST(ts AS DATE) AS event_date, user_id FROM ({_SQL_WIN_EVENTS}) e"
_SQL_WIN_PER_USER = (
    f"SELECT DISTINCT CAST(order_ts AS DATE) AS order_date, user_id FROM ({_SQL_WIN_ORDERS}) o"
)

_SQL_JOB_RUN_DATE = f"""
SELECT 'ingest' AS stage, 'orders' AS table_name, count(*) AS rows FROM ({_SQL_WIN_ORDERS}) o
UNION ALL SELECT 'ingest', 'events', count(*) FROM ({_SQL_WIN_EVENTS}) e
UNION ALL SELECT 'quality', 'quarantine',
  (SELECT count(*) FILTER (WHERE order_id IS NULL) + count(*) FILTER (WHERE amount <= 0) FROM ({_SQL_WIN_ORDERS}) o)
  + (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
     FROM (SELECT user_id, count(*) AS n FROM ({_SQL_USERS}) u GROUP BY 1) g)
UNION ALL SELECT 'quality', 'gate', 2 * (SELECT count(*) FROM ({_SQL_WIN_ORDERS}) o) + (SELECT count(*) FROM customer)
UNION ALL SELECT 'transform', 'revenue_by_day_user', count(*) FROM ({_SQL_WIN_PER_USER}) r
UNION ALL SELECT 'transform', 'active_user_days', count(*) FROM ({_SQL_WIN_PAIRS}) p
UNION ALL SELECT 'transform', 'daily_orders', count(DISTINCT CAST(order_ts AS DATE)) FROM ({_SQL_WIN_ORDERS}) o
UNION ALL SELECT 'transform', 'daily_revenue', count(*) FROM ({_SQL_WIN_PER_USER}) r
UNION ALL SELECT 'transform', 'daily_active_users', count(DISTINCT event_date) FROM ({_SQL_WIN_PAIRS}) p
UNION ALL SELECT 'transform', 'daily_active_users_by_channel', count(*) FROM (
  SELECT DISTINCT p.event_date, u.channel FROM ({_SQL_WIN_PAIRS}) p LEFT JOIN ({_SQL_USERS}) u ON p.user_id = u.user_id) c
UNION ALL SELECT 'transform', 'daily_revenue_by_channel', count(*) FROM (
  SELECT DISTINCT r.order_date, u.channel FROM ({_SQL_WIN_PER_USER}) r LEFT JOIN ({_SQL_USERS}) u ON r.user_id = u.user_id) c
UNION ALL SELECT 'transform', 'daily_conversion', count(DISTINCT event_date) FROM ({_SQL_WIN_PAIRS}) p"""


@register("daily_job_run_date", _SQL_JOB_RUN_DATE)
def q_daily_job_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job for one run date with a 7-day look-back on raw files named by day:
    only the window's files are read, its rows checked, aggregated and written."""
    root = shared_dir(spark, "daily_job_run_date")
    raw = join_uri(root, "raw")
    purchases = ST.raw_orders_frame(TB.purchases_table(spark, sf_dir)).withColumn("day", F.to_date("order_ts"))
    ST.stage_named_files(purchases, raw, "csv", ST.names_by_day(purchases, "orders", "csv"), "day")
    events = ST.raw_events_frame(spark, sf_dir)
    ST.stage_named_files(events, raw, "json", ST.names_by_day(events, "events", "ndjson"), "day")
    paths = JobPaths(
        raw=raw, bronze=join_uri(root, "bronze"), silver=join_uri(root, "silver"),
        users=join_uri(ST.stage_users_csv(spark, sf_dir, root), "*.csv"),
    )
    result = run_daily_job(spark, paths, run_date=JOB_RUN_DATE, days_back=JOB_DAYS_BACK, rules=PURCHASE_RULES)
    return result.stages_frame(spark).select("stage", "table_name", "rows")


# ---------------------------------------------------------------------------
# S5, second form: files of different layouts, UNION ALL by name.
# ---------------------------------------------------------------------------

from daymark.sources.csv import concat_frames  # noqa: E402


@register(
    "concat_mixed_layouts",
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, o_totalprice AS amount,
       o_orderdate AS order_ts, CAST(NULL AS VARCHAR) AS event_type FROM orders
UNION ALL
SELECT CAST(event_id AS VARCHAR), user_id, CAST(NULL AS DOUBLE), ts, event_type FROM events""",
)
def q_concat_mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order CSVs and event NDJSON in one frame: columns matched by name,
    a column one layout lacks is NULL there."""
    root = shared_dir(spark, "concat_mixed_layouts")
    orders = read_orders_csv(spark, ST.stage_orders_csv(spark, sf_dir, root)).select(*_ORDER_COLS)
    raw_events = read_ndjson(
        spark, ST.stage_events_ndjson(spark, sf_dir, root), recursive=True, name_glob="*.json"
    )
    events = typed_events(raw_events).select(
        F.col("event_id").cast("string").alias("order_id"),
        "user_id",
        F.col("ts").alias("order_ts"),
        "event_type",
    )
    return concat_frames([orders, events])


@register(
    "sink_warehouse_text",
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, "
    "CAST(count(DISTINCT user_id) AS VARCHAR) AS dau FROM events GROUP BY CAST(ts AS DATE)",
)
def q_sink_warehouse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse refresh with every column stored as text."""
    path = shared_dir(spark, "sink_warehouse_text")
    table = "fact_daily_active_users_text_" + path.rsplit("-", 1)[-1]
    dau = M.daily_active_users(TB.events_table(spark, sf_dir))
    return WH.refresh_catalog_table(spark, dau, table, path, text_columns=True)


# ---------------------------------------------------------------------------
# K8, K9, Q4: lines that do not parse, and files of the same name.
# ---------------------------------------------------------------------------


@register(
    "csv_parse_quarantine",
    f"""
SELECT 'orders' AS table_name, 'parse' AS rule, order_id || ',' || user_id || ',abc,2024-01-02 03:04:05' AS row_json
FROM ({_SQL_SCAN_PURCHASES}) o WHERE user_id % 7 = 3""",
)
def q_csv_parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose amount is no number are kept as text, the others are clean."""
    root = shared_dir(spark, "csv_parse_quarantine")
    rows = TB.purchases_table(spark, sf_dir)
    bad = F.col("user_id") % 7 == 3
    staged = ST.raw_orders_frame(rows).select(
        "order_id",
        "user_id",
        F.when(bad, "abc").otherwise(F.col("amount").cast("string")).alias("amount"),
        F.when(bad, "2024-01-02 03:04:05").otherwise(F.col("order_ts")).alias("order_ts"),
    )
    staged.write.option("header", True).csv(join_uri(root, "raw"))
    B.ingest_orders(spark, join_uri(root, "raw"), join_uri(root, "bronze"), name_glob="*.csv")
    return B.read_bronze_quarantine(spark, join_uri(root, "bronze"), "orders").select("table_name", "rule", "row_json")


@register(
    "event_parse_quarantine",
    """
SELECT 'events' AS table_name, 'parse' AS rule, '{"event_id":' || event_id || ',"user_id":"none"}' AS row_json
FROM events WHERE event_id % 50 = 7""",
)
def q_event_parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines whose user id is no number are kept as text."""
    root = shared_dir(spark, "event_parse_quarantine")
    good = F.to_json(F.struct("event_id", "user_id", "event_type", F.date_format("ts", ST.TS_TEXT).alias("ts")))
    bad = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":"none"}'))
    events = TB.read_table(spark, sf_dir, "events")
    events.select(F.when(F.col("event_id") % 50 == 7, bad).otherwise(good)).write.text(join_uri(root, "raw"))
    B.ingest_events(spark, join_uri(root, "raw"), join_uri(root, "bronze"), name_glob="*.txt")
    return B.read_bronze_quarantine(spark, join_uri(root, "bronze"), "events").select("table_name", "rule", "row_json")


@register("stream_same_file_names", f"{_SQL_SCAN_ORDERS}\nUNION ALL\n{_SQL_SCAN_PURCHASES}")
def q_stream_same_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with files of equal names, streamed one file at a time: no row is lost."""
    root = shared_dir(spark, "stream_same_file_names")
    for name, rows in (("a", TB.orders_table(spark, sf_dir)), ("b", TB.purchases_table(spark, sf_dir))):
        ST.stage_named_files(ST.raw_orders_frame(rows), join_uri(root, "raw", name), "csv", {None: "orders_2024-01-01.csv"})
    ingest_stream(spark, "orders", join_uri(root, "raw"), join_uri(root, "bronze"), max_files_per_trigger=1)
    return B.read_bronze_orders(spark, join_uri(root, "bronze")).select(*_ORDER_COLS)


# ---------------------------------------------------------------------------
# G1, G2, P4: the job on dated raw files, with rows that come in a later file.
# ---------------------------------------------------------------------------

_LATE_JOBS: dict[tuple[str, str], JobPaths] = {}


def _late_job(spark: SparkSession, sf_dir: str) -> JobPaths:
    """Paths of two runs: all of history from files named by day, which lack
    every tenth purchase; then, with the defaults, the run date after the last
    day, whose file brings those late rows.  Made once per application and tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _LATE_JOBS:
        return _LATE_JOBS[key]
    root = shared_dir(spark, "late_job")
    raw = join_uri(root, "raw")
    purchases = ST.raw_orders_frame(TB.purchases_table(spark, sf_dir)).withColumn("day", F.to_date("order_ts"))
    late = F.col("order_id").cast("long") % 10 == 3
    names = ST.names_by_day(purchases, "orders", "csv")
    after = max(names) + dt.timedelta(days=1)
    ST.stage_named_files(purchases.where(~late), raw, "csv", names, "day")
    ST.stage_named_files(purchases.where(late).drop("day"), join_uri(raw, "next"), "csv", {None: f"orders_{after}.csv"})
    users = ST.stage_users_csv(spark, sf_dir, root)
    paths = JobPaths(
        raw_orders=raw, raw_events=ST.stage_events_ndjson(spark, sf_dir, root), bronze=join_uri(root, "bronze"),
        silver=join_uri(root, "silver"), users=join_uri(users, "*.csv"),
        warehouse=join_uri(root, "warehouse"), database="daymark_" + root.rsplit("-", 1)[-1],
    )
    run_daily_job(spark, paths, raw_orders_glob="orders_{" + ",".join(map(str, names)) + "}.csv", raw_events_glob="*.json", rules=PURCHASE_RULES)
    paths.raw_events = None
    run_daily_job(spark, paths, run_date=after, rules=PURCHASE_RULES)
    _LATE_JOBS[key] = paths
    return paths


def _job_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return SK.read_back(spark, _late_job(spark, sf_dir).output(name), S.OUTPUT_SCHEMAS[name])

    return query


def _warehouse_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.table(f"{_late_job(spark, sf_dir).database}.{WAREHOUSE_TABLES[name]}")

    return query


for _name, _sql in _SQL_PURCHASE_TABLES.items():
    register(f"job_{_name}", _sql)(_job_query(_name))
    register(f"warehouse_{WAREHOUSE_TABLES[_name]}", _sql)(_warehouse_query(_name))


# ---------------------------------------------------------------------------
# G2, A1-A6, K2, S4: tables kept up to date by what changed, in one commit.
# ---------------------------------------------------------------------------


def _long(tables: dict[str, DataFrame]) -> DataFrame:
    """The six tables in one frame: table_name, day, key, and up to three measures."""
    parts = []
    for name, df in tables.items():
        key = next((c for c in ("user_id", "channel") if c in df.columns), None)
        measures = [c for c in S.OUTPUT_SCHEMAS[name].fieldNames() if c not in (PARTITION_COLUMNS[name], key)]
        values = [F.col(c).cast("double") for c in measures] + [F.lit(None).cast("double")] * (3 - len(measures))
        parts.append(df.select(
            F.lit(name).alias("table_name"), F.col(PARTITION_COLUMNS[name]).alias("day"),
            (F.col(key) if key else F.lit(None)).cast("string").alias("key"), *[v.alias(f"m{i}") for i, v in enumerate(values)],
        ))
    return concat_frames(parts)


def _sql_long(name: str) -> str:
    columns = S.OUTPUT_SCHEMAS[name].fieldNames()
    key = next((c for c in ("user_id", "channel") if c in columns), None)
    measures = [f"CAST({c} AS DOUBLE)" for c in columns if c not in (PARTITION_COLUMNS[name], key)]
    measures += ["CAST(NULL AS DOUBLE)"] * (3 - len(measures))
    fields = ", ".join(f"{m} AS m{i}" for i, m in enumerate(measures))
    key_text = f"CAST({key} AS VARCHAR)" if key else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{name}' AS table_name, {PARTITION_COLUMNS[name]} AS day, {key_text} AS key, {fields} FROM ({_SQL_PURCHASE_TABLES[name]}) t"


_SQL_ALL_LONG = "\nUNION ALL\n".join(_sql_long(name) for name in _SQL_PURCHASE_TABLES)


def _stage_corrected(spark: SparkSession, sf_dir: str, root: str, first: bool, names: dict) -> None:
    """Files named by day.  The first versions of the files of every third day lack some purchases,
    have others with a wrong amount or on the day after, and rows that are none; every file lacks the late
    purchases, which come in a file of their own."""
    raw = join_uri(root, "raw")
    rows = TB.purchases_table(spark, sf_dir).withColumn("day", F.to_date("order_ts"))
    number = F.col("order_id") % 10
    wrong = F.dayofmonth("day") % 3 == 0
    if first:
        good = rows.where(~wrong & (number != 3))
        bad = rows.where(wrong & ~number.isin(3, 4)).withColumns({
            "amount": F.when(number == 5, F.col("amount") + 1).otherwise(F.col("amount")),
            "order_ts": F.when(number == 6, F.col("order_ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("order_ts")),
        })
        none = rows.where(wrong & (number == 7)).withColumn("order_id", -F.col("order_id"))
        staged = good.unionByName(bad).unionByName(none)
    else:
        staged = rows.where(wrong & (number != 3))
        late = rows.where(number == 3).drop("day")
        ST.stage_named_files(ST.raw_orders_frame(late), join_uri(raw, "late"), "csv", {None: f"orders_{max(names) + dt.timedelta(days=1)}.csv"})
    files = {d: n for d, n in names.items() if first or d.day % 3 == 0}
    ST.stage_named_files(ST.raw_orders_frame(staged, "day"), raw, "csv", files, "day")


@register("incremental_tables", _SQL_ALL_LONG)
def q_incremental_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over files with errors, then one over the corrected files and a file
    of late rows: the six tables as committed by the second, which reads only those."""
    root = shared_dir(spark, "incremental_tables")
    names = ST.names_by_day(TB.purchases_table(spark, sf_dir).select(F.to_date("order_ts").alias("day")), "orders", "csv")
    paths = JobPaths(
        raw_orders=join_uri(root, "raw"), raw_events=ST.stage_events_ndjson(spark, sf_dir, root), bronze=join_uri(root, "bronze"),
        silver=join_uri(root, "silver"), users=join_uri(ST.stage_users_csv(spark, sf_dir, root), "*.csv"),
    )
    for first in (True, False):
        _stage_corrected(spark, sf_dir, root, first, names)
        I.run_incremental(spark, paths, rules=PURCHASE_RULES, globs={"orders": "orders_*.csv", "events": "*.json"})
    return _long({name: I.read_table(spark, paths, name) for name in _SQL_PURCHASE_TABLES})


@register(
    "unique_over_ingests",
    f"""
SELECT 'orders' AS table_name, '{K.RULE}' AS rule, order_id, CAST(NULL AS VARCHAR) AS earlier_file, CAST(NULL AS BIGINT) AS earlier_rows
FROM ({_SQL_SCAN_PURCHASES}) o WHERE CAST(order_id AS BIGINT) % 20 = 0
UNION ALL
SELECT 'orders', '{K.RULE}', order_id, 'a/orders_2024-01-01.csv', 1
FROM ({_SQL_SCAN_PURCHASES}) o WHERE CAST(order_id AS BIGINT) % 20 = 0""",
)
def q_unique_over_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second ingest brings every tenth order id of the first again: the gate stops it, and
    quarantine has the new rows and where the earlier ones are, found in the key index."""
    root = shared_dir(spark, "unique_over_ingests")
    rows = TB.purchases_table(spark, sf_dir)
    paths = JobPaths(
        raw_orders=join_uri(root, "raw"), bronze=join_uri(root, "bronze"), silver=join_uri(root, "silver"),
        users=join_uri(ST.stage_users_csv(spark, sf_dir, root), "*.csv"),
    )
    for folder, some in (("a", F.col("order_id") % 2 == 0), ("b", (F.col("order_id") % 2 == 1) | (F.col("order_id") % 20 == 0))):
        staged = ST.raw_orders_frame(rows.where(some))
        ST.stage_named_files(staged, join_uri(root, "raw", folder), "csv", {None: f"orders_2024-01-0{'ab'.index(folder) + 1}.csv"})
        try:
            I.run_incremental(spark, paths, rules=PURCHASE_RULES, unique_orders=True)
        except DQ.DataQualityError:
            if folder == "a":
                raise
    kept = spark.read.schema("table_name string, rule string, row_json string").parquet(join_uri(root, "bronze", "_quality")).where(F.col("rule") == K.RULE)
    row = F.from_json("row_json", "order_id string, source_file string, rows long")
    return kept.select("table_name", "rule", row.alias("r")).select(
        "table_name", "rule", "r.order_id", F.col("r.source_file").alias("earlier_file"), F.col("r.rows").alias("earlier_rows")
    )


@register(
    "snapshot_of_two_tables",
    f"""
SELECT 'daily_active_users' AS table_name, event_date AS day, CAST(dau AS DOUBLE) AS value FROM ({ORACLE_SQL["daily_active_users"]}) a
UNION ALL
SELECT 'daily_orders', order_date, revenue FROM ({_SQL_PURCHASE_TABLES["daily_orders"]}) b""",
)
def q_snapshot_of_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables with wrong days, a writer that dies between them, and a commit that restates
    those days: readers see the last commit only."""
    store = SnapshotStore(spark, shared_dir(spark, "snapshot_of_two_tables"))
    tables = {
        "daily_active_users": (M.daily_active_users(TB.events_table(spark, sf_dir)), "event_date", "dau"),
        "daily_orders": (M.daily_orders(TB.purchases_table(spark, sf_dir)), "order_date", "revenue"),
    }
    wrong = F.dayofmonth("day") % 5 == 0
    days = [r["day"] for r in tables["daily_active_users"][0].select(F.col("event_date").alias("day")).where(wrong).collect()]
    t = store.begin()
    for name, (df, day, value) in tables.items():
        bad = F.dayofmonth(day) % 5 == 0
        t.write(name, df.withColumn(value, F.when(bad, F.col(value) + 1).otherwise(F.col(value)).cast(S.OUTPUT_SCHEMAS[name][value].dataType)), day)
    t.commit()
    dead = store.begin()
    dead.write("daily_orders", tables["daily_orders"][0].withColumn("revenue", F.lit(0.0)), "order_date")
    t = store.begin()
    for name, (df, day, _) in tables.items():
        t.write(name, df, day, values=days)
    done = t.commit()
    return concat_frames([
        store.read(name, S.OUTPUT_SCHEMAS[name], snapshot=done).select(F.lit(name).alias("table_name"), F.col(day).alias("day"), F.col(value).cast("double").alias("value"))
        for name, (_, day, value) in tables.items()
    ])


# ---------------------------------------------------------------------------
# K6, K8, S1: publishing of changes, compaction, layouts.
# ---------------------------------------------------------------------------


@register("publish_corrected", ORACLE_SQL["daily_orders_purchases"])
def q_publish_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store with wrong and surplus days is published, then corrected and published
    again: the target has the corrected table."""
    root = shared_dir(spark, "publish_corrected")
    source, target = SnapshotStore(spark, join_uri(root, "silver")), SnapshotStore(spark, join_uri(root, "published"))
    right = M.daily_orders(TB.purchases_table(spark, sf_dir))
    third = F.dayofmonth("order_date") % 3 == 0
    wrong = right.withColumn("orders", F.col("orders") + third.cast("int")).unionByName(right.withColumn("order_date", F.date_sub("order_date", 400)))
    for df in (wrong, right):
        t = source.begin()
        t.write("daily_orders", df, "order_date")
        t.commit()
        WH.publish_changes(source, target, {"daily_orders": S.OUTPUT_SCHEMAS["daily_orders"]})
    return target.read("daily_orders", S.OUTPUT_SCHEMAS["daily_orders"])


@register("bronze_compacted", _SQL_SCAN_PURCHASES)
def q_bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ingests of files of different headers, one of them read again in a corrected version,
    rewritten into one; the replaced ingests are deleted."""
    root = shared_dir(spark, "bronze_compacted")
    raw, bronze = join_uri(root, "raw"), join_uri(root, "bronze")
    rows = TB.purchases_table(spark, sf_dir)
    part = F.col("order_id") % 3
    columns = [("order_id", "user_id", "amount", "order_ts"), ("order_ts", "order_id", "user_id", "amount"), ("amount", "order_ts", "note", "order_id", "user_id")]
    for i, names in enumerate(columns):
        staged = ST.raw_orders_frame(rows.where(part == i)).withColumn("note", F.lit("x, y")).select(*names)
        if i == 1:
            ST.stage_named_files(staged.withColumn("amount", F.lit(-1.0)), raw, "csv", {None: f"orders_2024-02-0{i + 1}.csv"})
            B.ingest_orders(spark, raw, bronze, f"2024-02-0{i + 1}")
        ST.stage_named_files(staged, raw, "csv", {None: f"orders_2024-02-0{i + 1}.csv"})
        B.ingest_orders(spark, raw, bronze, f"2024-02-0{i + 1}")
    compact_bronze(spark, bronze, "orders")
    vacuum_bronze(spark, bronze, "orders", older_than=dt.timedelta(0))
    return B.read_bronze_orders(spark, bronze).select(*_ORDER_COLS)


@register("stream_mixed_layouts", _SQL_SCAN_PURCHASES)
def q_stream_mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two headers in one folder, streamed: each is read by its own."""
    root = shared_dir(spark, "stream_mixed_layouts")
    rows = ST.raw_orders_frame(TB.purchases_table(spark, sf_dir))
    odd = F.col("order_id").cast("long") % 2 == 1
    ST.stage_named_files(rows.where(odd), join_uri(root, "raw"), "csv", {None: "orders_2024-01-01.csv"})
    ST.stage_named_files(rows.where(~odd).select("order_ts", "amount", "order_id", "user_id"), join_uri(root, "raw"), "csv", {None: "orders_2024-01-02.csv"})
    ingest_stream(spark, "orders", join_uri(root, "raw"), join_uri(root, "bronze"))
    return B.read_bronze_orders(spark, join_uri(root, "bronze")).select(*_ORDER_COLS)


@register("replayed_quarantine", _SQL_SCAN_PURCHASES)
def q_replayed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose amounts carry a currency go to quarantine; a replay without it gives the clean load."""
    root = shared_dir(spark, "replayed_quarantine")
    raw, bronze = join_uri(root, "raw"), join_uri(root, "bronze")
    staged = ST.raw_orders_frame(TB.purchases_table(spark, sf_dir))
    amount = F.col("amount").cast("string")
    staged.withColumn("amount", F.when(F.col("user_id") % 7 == 3, F.concat(amount, F.lit(" EUR"))).otherwise(amount)).write.option("header", True).csv(raw)
    B.ingest_orders(spark, raw, bronze, name_glob="*.csv")
    replay_quarantine(spark, bronze, "orders", lambda line: F.regexp_replace(line, " EUR", ""))
    return B.read_bronze_orders(spark, bronze).select(*_ORDER_COLS)
