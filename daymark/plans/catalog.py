"""Registered queries over the warehouse tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); the SQL is
the same computation written for DuckDB over the same Parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daymark.operators import metrics as M
from daymark.plans.daily import restrict_days
from daymark.sources import tables as TB

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


# ---------------------------------------------------------------------------
# SQL fragments for the oracle (DuckDB dialect).
# ---------------------------------------------------------------------------

def _money(expr: str) -> str:
    return f"round(CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE), 2)"


# orders-shaped relations: (order_id, user_id, amount, order_ts)
_SQL_ORDERS = (
    "SELECT o_orderkey AS order_id, o_custkey AS user_id, "
    "o_totalprice AS amount, o_orderdate AS order_ts FROM orders"
)
_SQL_PURCHASES = (
    "SELECT event_id AS order_id, user_id, value AS amount, ts AS order_ts "
    "FROM events WHERE event_type = 'purchase'"
)
_SQL_USERS = "SELECT c_custkey AS user_id, c_mktsegment AS channel FROM customer"

RUN_DATE = "1997-03-01"
LOOKBACK_DAYS = 7


def _sql_daily_orders(src: str, where: str = "") -> str:
    return f"""
SELECT CAST(order_ts AS DATE) AS order_date,
       count(DISTINCT order_id) AS orders,
       count(DISTINCT user_id) AS buyers,
       {_money('amount')} AS revenue
FROM ({src}) o {where}
GROUP BY 1"""


def _sql_conversion(src: str, rounded: bool) -> str:
    rate = "CAST(coalesce(b.buyers, 0) AS DOUBLE) / nullif(d.dau, 0)"
    if rounded:
        rate = f"round({rate}, 4)"
    return f"""
WITH d AS (SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS dau
           FROM events GROUP BY 1),
     b AS (SELECT CAST(order_ts AS DATE) AS order_date, count(DISTINCT user_id) AS buyers
           FROM ({src}) o GROUP BY 1)
SELECT d.event_date AS "date", d.dau, coalesce(b.buyers, 0) AS buyers, {rate} AS conv_rate
FROM d LEFT JOIN b ON d.event_date = b.order_date"""


# ---------------------------------------------------------------------------
# A1-A7: the six daily metrics and row distinct.
# ---------------------------------------------------------------------------

@register("daily_orders", _sql_daily_orders(_SQL_ORDERS))
def q_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_orders(TB.orders_table(spark, sf_dir))


@register("daily_orders_purchases", _sql_daily_orders(_SQL_PURCHASES))
def q_daily_orders_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_orders(TB.purchases_table(spark, sf_dir))


@register(
    "daily_orders_run_date",
    _sql_daily_orders(_SQL_ORDERS, f"WHERE CAST(order_ts AS DATE) = DATE '{RUN_DATE}'"),
)
def q_daily_orders_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = restrict_days(TB.orders_table(spark, sf_dir), "order_ts", RUN_DATE)
    return M.daily_orders(orders)


@register(
    "daily_orders_lookback",
    _sql_daily_orders(
        _SQL_ORDERS,
        f"WHERE CAST(order_ts AS DATE) BETWEEN DATE '{RUN_DATE}' - INTERVAL "
        f"{LOOKBACK_DAYS - 1} DAY AND DATE '{RUN_DATE}'",
    ),
)
def q_daily_orders_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = restrict_days(
        TB.orders_table(spark, sf_dir), "order_ts", RUN_DATE, LOOKBACK_DAYS
    )
    return M.daily_orders(orders)


@register(
    "daily_revenue",
    f"""
SELECT CAST(order_ts AS DATE) AS order_date, user_id, {_money('amount')} AS amount
FROM ({_SQL_ORDERS}) o GROUP BY 1, 2""",
)
def q_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_revenue(TB.orders_table(spark, sf_dir))


@register(
    "daily_active_users",
    "SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS dau "
    "FROM events GROUP BY 1",
)
def q_daily_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_active_users(TB.events_table(spark, sf_dir))


@register(
    "active_user_days",
    "SELECT DISTINCT CAST(ts AS DATE) AS event_date, user_id FROM events",
)
def q_active_user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.active_user_days(TB.events_table(spark, sf_dir))


@register(
    "daily_active_users_by_channel",
    f"""
SELECT p.event_date, u.channel, count(DISTINCT p.user_id) AS dau
FROM (SELECT DISTINCT CAST(ts AS DATE) AS event_date, user_id FROM events) p
LEFT JOIN ({_SQL_USERS}) u ON p.user_id = u.user_id
GROUP BY 1, 2""",
)
def q_daily_active_users_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_active_users_by_channel(
        TB.events_table(spark, sf_dir), TB.users_table(spark, sf_dir)
    )


@register(
    "daily_revenue_by_channel",
    f"""
SELECT CAST(o.order_ts AS DATE) AS order_date, u.channel, {_money('o.amount')} AS revenue
FROM ({_SQL_ORDERS}) o LEFT JOIN ({_SQL_USERS}) u ON o.user_id = u.user_id
GROUP BY 1, 2""",
)
def q_daily_revenue_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_revenue_by_channel(
        TB.orders_table(spark, sf_dir), TB.users_table(spark, sf_dir)
    )


@register("daily_conversion", _sql_conversion(_SQL_ORDERS, rounded=True))
def q_daily_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_conversion(TB.events_table(spark, sf_dir), TB.orders_table(spark, sf_dir))


@register("daily_conversion_purchases", _sql_conversion(_SQL_PURCHASES, rounded=True))
def q_daily_conversion_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_conversion(
        TB.events_table(spark, sf_dir), TB.purchases_table(spark, sf_dir)
    )


@register("daily_conversion_raw", _sql_conversion(_SQL_PURCHASES, rounded=False))
def q_daily_conversion_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_conversion(
        TB.events_table(spark, sf_dir), TB.purchases_table(spark, sf_dir), round_to=None
    )


# ---------------------------------------------------------------------------
# Q1-Q7: data quality.
# ---------------------------------------------------------------------------

from daymark.operators import quality as DQ  # noqa: E402

# Rules the catalog runs over the warehouse tables: the job's three declared
# rules plus one of each check on columns that do violate them.
DQ_RULES: tuple[DQ.Rule, ...] = DQ.DEFAULT_RULES + (
    DQ.Rule("labeled_documents", "quality", "not_null"),
    DQ.Rule("accounts", "c_acctbal", "gt_zero"),
    DQ.Rule("orders", "user_id", "unique"),
)


def dq_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": TB.orders_table(spark, sf_dir).select("order_id", "user_id", "amount"),
        "users": TB.users_table(spark, sf_dir),
        "labeled_documents": TB.labeled_documents_table(spark, sf_dir),
        "accounts": TB.accounts_table(spark, sf_dir),
    }


@register(
    "dq_not_null_rows",
    """
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL""",
)
def q_dq_not_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.violations(
        TB.labeled_documents_table(spark, sf_dir), DQ.Rule("labeled_documents", "quality", "not_null")
    )


@register(
    "dq_gt_zero_rows",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0",
)
def q_dq_gt_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.violations(TB.accounts_table(spark, sf_dir), DQ.Rule("accounts", "c_acctbal", "gt_zero"))


@register(
    "dq_unique_rows",
    """
SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)
   OR (o_custkey IS NULL AND (SELECT count(*) FROM orders WHERE o_custkey IS NULL) > 1)""",
)
def q_dq_unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = TB.orders_table(spark, sf_dir).select("order_id", "user_id")
    return DQ.violations(orders, DQ.Rule("orders", "user_id", "unique"))


def _sql_json_rows(table: str, rule: str, src: str, cols: tuple[str, ...], where: str) -> str:
    packed = ", ".join(f"{c} := {c}" for c in cols)
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"CAST(to_json(struct_pack({packed})) AS VARCHAR) AS row_json FROM ({src}) t WHERE {where}"
    )


def _sql_dup(src: str, col: str) -> str:
    return (
        f"({col} IN (SELECT {col} FROM ({src}) s GROUP BY 1 HAVING count(*) > 1) OR "
        f"({col} IS NULL AND (SELECT count(*) FROM ({src}) s WHERE {col} IS NULL) > 1))"
    )


_SQL_DQ_ORDERS = "SELECT order_id, user_id, amount FROM (" + _SQL_ORDERS + ") o"
_ORDER_COLS = ("order_id", "user_id", "amount")

_SQL_QUARANTINE = "\nUNION ALL\n".join([
    _sql_json_rows("orders", "not_null(order_id)", _SQL_DQ_ORDERS, _ORDER_COLS, "order_id IS NULL"),
    _sql_json_rows("orders", "gt_zero(amount)", _SQL_DQ_ORDERS, _ORDER_COLS, "amount <= 0"),
    _sql_json_rows("users", "unique(user_id)", _SQL_USERS, ("user_id", "channel"),
                   _sql_dup(_SQL_USERS, "user_id")),
    _sql_json_rows("labeled_documents", "not_null(quality)",
                   "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
                   ("doc_id", "quality"), "quality IS NULL"),
    _sql_json_rows("accounts", "gt_zero(c_acctbal)", "SELECT c_custkey, c_acctbal FROM customer",
                   ("c_custkey", "c_acctbal"), "c_acctbal <= 0"),
    _sql_json_rows("orders", "unique(user_id)", _SQL_DQ_ORDERS, _ORDER_COLS,
                   _sql_dup(_SQL_DQ_ORDERS, "user_id")),
])


@register("dq_quarantine", _SQL_QUARANTINE)
def q_dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.quarantine(dq_tables(spark, sf_dir), DQ_RULES)


def _sql_row_rule(table_sql: str, table: str, label: str, fail: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{label}' AS rule, count(*) AS rows_checked, "
        f"count(*) FILTER (WHERE {fail}) AS violations FROM ({table_sql}) t"
    )


def _sql_unique_rule(table_sql: str, table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'unique({column})' AS rule, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_checked, "
        f"CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS violations "
        f"FROM (SELECT {column}, count(*) AS n FROM ({table_sql}) t GROUP BY {column}) g"
    )


_SQL_LABELED = (
    "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)

_SQL_RULE_SUMMARY = "SELECT table_name, rule, rows_checked, violations, violations = 0 AS ok FROM (\n" + "\nUNION ALL\n".join([
    _sql_row_rule(_SQL_ORDERS, "orders", "not_null(order_id)", "order_id IS NULL"),
    _sql_row_rule(_SQL_ORDERS, "orders", "gt_zero(amount)", "amount <= 0"),
    _sql_unique_rule(_SQL_USERS, "users", "user_id"),
    _sql_row_rule(_SQL_LABELED, "labeled_documents", "not_null(quality)", "quality IS NULL"),
    _sql_row_rule("SELECT * FROM customer", "accounts", "gt_zero(c_acctbal)", "c_acctbal <= 0"),
    _sql_unique_rule(_SQL_ORDERS, "orders", "user_id"),
]) + "\n) s"


@register("dq_rule_summary", _SQL_RULE_SUMMARY)
def q_dq_rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.rule_summary(dq_tables(spark, sf_dir), DQ_RULES)


@register(
    "dq_run_summary",
    f"""
SELECT count(*) AS rules_run, count(*) FILTER (WHERE NOT ok) AS failed_rules,
       CAST(coalesce(sum(violations), 0) AS BIGINT) AS violations,
       coalesce(bool_and(ok), true) AS passed
FROM ({_SQL_RULE_SUMMARY}) r""",
)
def q_dq_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.run_summary(DQ.rule_summary(dq_tables(spark, sf_dir), DQ_RULES))


# Round trips register themselves on import (they reuse the SQL above).
from daymark.plans import catalog_io  # noqa: E402,F401
