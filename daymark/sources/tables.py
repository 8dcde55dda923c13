"""Adapters from the warehouse-style Parquet tables onto the job's inputs.

orders    ← orders    (o_orderkey, o_custkey, o_totalprice, o_orderdate)
purchases ← events    where event_type = 'purchase' (event_id, user_id, value, ts)
events    ← events    (event_id, user_id, event_type, ts)
users     ← customer  (c_custkey, c_mktsegment)

Each adapter selects only the columns it maps, so the Parquet scan reads
just those (ReadSchema) and filters push into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("order_ts"),
    )


def purchases_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("order_id"),
            "user_id",
            F.col("value").alias("amount"),
            F.col("ts").alias("order_ts"),
        )
    )


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts"
    )


def users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("channel"),
    )


def labeled_documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⟕ labels on doc_id → (doc_id, quality); unlabeled → NULL."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")


def accounts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
