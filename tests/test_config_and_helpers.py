from __future__ import annotations

import datetime as dt

import pytest

from daymark.config import load_config, quality_rules, spark_conf
from daymark.functions.temporal import lookback_bounds, parse_run_date
from daymark.operators.joins import fits_broadcast, prepare_dimension
from daymark.operators.quality import DEFAULT_RULES
from daymark.session import checkpoint_root, shared_dir


def test_parse_run_date():
    assert parse_run_date("2024-01-05") == dt.date(2024, 1, 5)
    assert parse_run_date(None) is None and parse_run_date("") is None
    for junk in ("05/01/2024", "2024-01-05T10:00:00", "2024-01-15garbage", "2024-01-159", "20240105"):
        with pytest.raises(ValueError):
            parse_run_date(junk)


def test_lookback_bounds():
    assert lookback_bounds(dt.date(2024, 1, 7), 7) == (dt.date(2024, 1, 1), dt.date(2024, 1, 7))
    with pytest.raises(ValueError):
        lookback_bounds(dt.date(2024, 1, 7), 0)


def test_config_yaml_env_and_rules(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text(
        "paths: {bronze: /b, silver: /s}\n"
        "pipeline: {days_back: 7}\n"
        "quality_rules:\n  orders:\n    - {name: n, column: order_id, check: not_null}\n"
        "spark_conf: {spark.sql.shuffle.partitions: 64}\n"
    )
    cfg = load_config(str(p), env={"RUN_DATE": "2024-02-01", "DAYMARK_PATH_SILVER": "s3://x/s",
                                   "DAYMARK_OUTPUT_DAILY_ORDERS": "/o"})
    assert cfg["paths"] == {"bronze": "/b", "silver": "s3://x/s"}
    assert cfg["outputs"] == {"daily_orders": "/o"}
    assert cfg["run_date"] == dt.date(2024, 2, 1)
    assert cfg["pipeline"]["days_back"] == 7 and cfg["pipeline"]["silver_format"] == "parquet"
    assert [r.label for r in quality_rules(cfg)] == ["not_null(order_id)"]
    assert spark_conf(cfg) == {"spark.sql.shuffle.partitions": "64"}
    assert quality_rules(load_config({}, env={})) == list(DEFAULT_RULES)


def test_shared_dir_is_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(root) and a != b


def test_broadcast_decision_is_measured(spark):
    small = spark.range(10)
    assert fits_broadcast(small, 10) and not fits_broadcast(small, 9)
    plan_b = prepare_dimension(small, max_rows=100)._jdf.queryExecution().logical().toString()
    plan_s = prepare_dimension(small, max_rows=5)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan_b.lower() and "shuffle_merge" in plan_s.lower()


def test_parse_timestamp_forms(spark):
    import datetime as dt

    from daymark.functions.temporal import parse_timestamp

    df = spark.createDataFrame(
        [("2024-01-01 10:00:00",), ("2024-01-01T23:30:00+05:00",), ("2024-03-31 02:30:00",),
         ("x",), (None,), ("2024-01-02 08:00:00.123456",), ("2024-01-02T08:00:00Z",),
         ("2024-01-02T08:00:00z",), ("2024-01-15 23:30:00 America/New_York",), ("2024-01-15",)],
        "s string",
    )
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [
        dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 18, 30),
        dt.datetime(2024, 3, 31, 2, 30), None, None,
        dt.datetime(2024, 1, 2, 8, 0, 0, 123456), dt.datetime(2024, 1, 2, 8, 0),
        dt.datetime(2024, 1, 2, 8, 0), dt.datetime(2024, 1, 16, 4, 30), dt.datetime(2024, 1, 15),
    ]


def test_checkpoint_root_requires_shared_folder_on_a_cluster(spark, monkeypatch):
    from pyspark import SparkConf

    import daymark.session as SS

    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: SparkConf(loadDefaults=False))
    monkeypatch.setattr(SS, "_LOCAL_FALLBACK", {})
    monkeypatch.setattr(SS, "_is_local", lambda s: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SS.checkpoint_root(spark)
    monkeypatch.setattr(SS, "_is_local", lambda s: True)
    root = SS.checkpoint_root(spark)
    assert root and SS.checkpoint_root(spark) == root       # one private folder per app
