"""Raw drops derived from the warehouse tables.

The round-trip queries need raw CSV / NDJSON files; these helpers write them
from the given tables (so their size grows with the tables) in the layout
the raw contract describes: text timestamps, header CSV, one JSON object per
line, events in one folder per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.sources import tables as TB
from daymark.sources.files import join_uri

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def raw_orders_frame(orders: DataFrame, *more: str) -> DataFrame:
    return orders.select(
        F.col("order_id").cast("string").alias("order_id"),
        "user_id",
        "amount",
        F.date_format("order_ts", TS_TEXT).alias("order_ts"),
        *more,
    )


def stage_orders_csv(spark: SparkSession, sf_dir: str, root: str, purchases: bool = False) -> str:
    src = TB.purchases_table(spark, sf_dir) if purchases else TB.orders_table(spark, sf_dir)
    path = join_uri(root, "raw", "purchases" if purchases else "orders")
    raw_orders_frame(src).write.mode("overwrite").option("header", True).csv(path)
    return path


def stage_users_csv(spark: SparkSession, sf_dir: str, root: str) -> str:
    path = join_uri(root, "raw", "users")
    TB.users_table(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return path


def raw_events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.read_table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.date_format("ts", TS_TEXT).alias("ts"),
        F.from_json("props", "map<string,bigint>").alias("props"),
        F.to_date("ts").alias("day"),
    )


def stage_events_ndjson(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Events as NDJSON in ``day=<yyyy-MM-dd>`` folders; props as a nested object."""
    path = join_uri(root, "raw", "events")
    raw_events_frame(spark, sf_dir).write.mode("overwrite").partitionBy("day").json(path)
    return path


def names_by_day(rows: DataFrame, kind: str, ext: str) -> dict:
    """``<kind>_<day>.<ext>`` for every day of the rows (one row per day)."""
    return {r["day"]: f"{kind}_{r['day']}.{ext}" for r in rows.select("day").distinct().orderBy("day").collect()}


def stage_named_files(rows: DataFrame, folder: str, fmt: str, names: dict, column: str | None = None) -> None:
    """Write files with given names: one per value of ``column``, or one for all."""
    spark = rows.sparkSession
    work = join_uri(folder, "_work")
    out = rows.repartition(column).write.partitionBy(column) if column else rows.coalesce(1).write
    out.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(work)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(work).getFileSystem(spark._jsc.hadoopConfiguration())
    for value, name in names.items():
        source = join_uri(work, f"{column}={value}") if column else work
        for status in fs.globStatus(hadoop.Path(join_uri(source, "part-*"))):
            target = hadoop.Path(join_uri(folder, name))
            fs.delete(target, False)   # a file of this name is corrected
            fs.rename(status.getPath(), target)
    fs.delete(hadoop.Path(work), True)
