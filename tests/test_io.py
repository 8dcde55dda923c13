"""Scans, ingest, sinks and the job on literal files in a temp folder."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException

from daymark import schemas as S
from daymark.operators import metrics as M
from daymark.operators.quality import DataQualityError
from daymark.plans import bronze as B
from daymark.plans.daily import WAREHOUSE_TABLES
from daymark.plans.job import JobPaths, run_daily_job
from daymark.sinks import files as SK
from daymark.sinks import warehouse as WH
from daymark.sources import files as FS
from daymark.sources.csv import concat_frames, read_orders_csv, read_users_csv
from daymark.sources.ndjson import read_ndjson, split_corrupt, typed_events
from tests.conftest import d, ts


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


ORDERS_HEADER = "order_id,user_id,amount,order_ts\n"


@pytest.fixture()
def raw_dir(tmp_path):
    root = tmp_path / "raw"
    write(str(root / "orders_2024-01-01.csv"), ORDERS_HEADER
          + "A1,1,5.00,2024-01-01 10:00:00\nA2,2,7.00,2024-01-01 11:00:00\nA3,,3.50,x\n")
    write(str(root / "orders_2024-01-02.csv"), ORDERS_HEADER
          + "B1,1,1.00,2024-01-02 10:00:00\nB2,3,2.00,2024-01-01 23:00:00\n")
    write(str(root / "events_2024-01-01.ndjson"),
          '{"event_id":1,"user_id":1,"event_type":"view","ts":"2024-01-01 09:00:00","props":{"k":1}}\n'
          "\n"
          '{"event_id":2,"user_id":2,"ts":"2024-01-01 09:30:00","extra":"ignored"}\n'
          "this is not json\n")
    write(str(root / "events_2024-01-02.ndjson"),
          '{"event_id":3,"user_id":1,"event_type":"view","ts":"2024-01-02 08:00:00"}\n')
    write(str(tmp_path / "ref" / "users.csv"), "user_id,channel\n1,ads\n2,seo\n3,ads\n")
    return str(root)


def test_csv_scan_declared_schema_and_junk_timestamp(spark, raw_dir):
    df = read_orders_csv(spark, os.path.join(raw_dir, "orders_2024-01-01.csv"))
    assert df.schema["order_ts"].dataType.simpleString() == "timestamp_ntz"
    got = sorted((r.order_id, r.user_id, r.amount, r.order_ts) for r in df.collect())
    assert got[2] == ("A3", None, 3.5, None)


def test_csv_reordered_header_fails(spark, tmp_path):
    p = write(str(tmp_path / "orders_2024-01-03.csv"),
              "user_id,order_id,amount,order_ts\n5,C1,1.00,2024-01-03 10:00:00\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_orders_csv(spark, p).collect()


def test_csv_glob_by_run_date(spark, raw_dir):
    one = read_orders_csv(spark, raw_dir, recursive=True, name_glob=FS.raw_pattern("orders", "2024-01-02"))
    assert sorted(r.order_id for r in one.collect()) == ["B1", "B2"]
    every = read_orders_csv(spark, raw_dir, recursive=True, name_glob=FS.raw_pattern("orders"))
    assert every.count() == 5


def test_missing_input_raises_unless_allowed(spark, tmp_path):
    missing = str(tmp_path / "nothing" / "orders_*.csv")
    with pytest.raises(AnalysisException):
        read_orders_csv(spark, missing)
    empty = read_orders_csv(spark, missing, allow_empty=True)
    assert empty.count() == 0 and empty.columns == S.ORDERS.fieldNames()


def test_ndjson_edge_cases(spark, raw_dir):
    raw = read_ndjson(spark, os.path.join(raw_dir, "events_2024-01-01.ndjson"))
    clean, bad = split_corrupt(typed_events(raw))
    rows = sorted(clean.collect(), key=lambda r: r.event_id)
    assert [r.event_id for r in rows] == [1, 2]            # blank line skipped
    assert rows[0].props == '{"k":1}'                       # nested → JSON text
    assert rows[1].event_type is None                       # missing key → NULL
    assert "extra" not in clean.columns                     # extra key ignored
    assert [r.row_json for r in bad.collect()] == ["this is not json"]


def test_provenance_from_file_name(spark, raw_dir):
    raw = FS.with_provenance(read_ndjson(spark, raw_dir, recursive=True, name_glob="events_*.ndjson"))
    got = {(r.source_file, r.file_date) for r in raw.collect()}
    assert got == {
        ("events_2024-01-01.ndjson", d("2024-01-01")),
        ("events_2024-01-02.ndjson", d("2024-01-02")),
    }


def test_concat_different_layouts(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, 3.0)], "id long, b double")
    got = sorted(tuple(r) for r in concat_frames([a, b]).collect())
    assert got == [(1, "x", None), (2, None, 3.0)]


def test_users_csv_with_signup(spark, tmp_path):
    p = write(str(tmp_path / "users.csv"), "user_id,channel,signup_date\n1,ads,2023-05-01\n")
    df = read_users_csv(spark, p, by_header=True)
    assert df.collect()[0].signup_date == "2023-05-01"     # a column the schema does not know is text


def test_uri_helpers(tmp_path):
    assert FS.normalise_uri("s3://bucket/raw") == "s3a://bucket/raw"
    assert FS.normalise_uri("hdfs://nn/x") == "hdfs://nn/x"
    assert FS.normalise_uri("rel/dir").startswith("/")
    made = FS.normalise_uri(str(tmp_path / "new" / "dir"), mkdir=True)
    assert os.path.isdir(made)
    assert FS.join_uri("s3a://b/silver/", "/users.csv") == "s3a://b/silver/users.csv"
    assert FS.raw_pattern("events", dt.date(2024, 1, 2), "ndjson") == "events_2024-01-02.ndjson"


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path, make_orders):
    o = make_orders([
        ("A1", 1, 1.0, ts("2024-01-01 10:00:00")),
        ("A2", 1, 2.0, ts("2024-01-02 10:00:00")),
    ])
    path = str(tmp_path / "daily_orders")
    SK.write_partitioned(M.daily_orders(o), path, ["order_date"])
    fix = make_orders([("A2", 1, 5.0, ts("2024-01-02 10:00:00"))])
    res = SK.write_partitioned(M.daily_orders(fix), path, ["order_date"])
    assert res.rows == 1
    back = {r.order_date: r.revenue for r in SK.read_back(spark, path, S.DAILY_ORDERS).collect()}
    assert back == {d("2024-01-01"): 1.0, d("2024-01-02"): 5.0}
    # static overwrite (the old default) drops the other day
    SK.write_partitioned(M.daily_orders(fix), path, ["order_date"], dynamic=False)
    assert SK.read_back(spark, path, S.DAILY_ORDERS).count() == 1


def test_csv_partitioned_roundtrip_with_null_day(spark, tmp_path, make_orders):
    o = make_orders([("A1", 1, 1.0, None), ("A2", 1, 2.0, ts("2024-01-02 10:00:00"))])
    path = str(tmp_path / "csv")
    SK.write_partitioned(M.daily_orders(o), path, ["order_date"], fmt="csv", stringify=True)
    back = SK.read_back(spark, path, S.DAILY_ORDERS, fmt="csv")
    assert sorted(((r.order_date, r.revenue) for r in back.collect()), key=repr) == sorted(
        [(None, 1.0), (d("2024-01-02"), 2.0)], key=repr
    )


def test_spread_partitions_is_deterministic(spark, make_orders):
    o = make_orders([("A%d" % i, i, 1.0, ts("2024-01-01 10:00:00")) for i in range(50)])
    a = SK.spread_partitions(o, ["order_id"], 4)
    assert a.count() == 50


def test_flat_export_and_catalog_refresh(spark, tmp_path, make_orders):
    o = make_orders([("A1", 1, 1.0, ts("2024-01-01 10:00:00"))])
    res = SK.write_flat(M.daily_revenue(o), str(tmp_path / "flat"), single_file=True)
    assert res.rows == 1 and len([f for f in os.listdir(tmp_path / "flat") if f.endswith(".csv")]) == 1
    t = WH.refresh_catalog_table(spark, M.daily_revenue(o), "t_refresh_test", str(tmp_path / "wh"), text_columns=True)
    assert [f.dataType.simpleString() for f in t.schema.fields] == ["string"] * 3
    t2 = WH.refresh_catalog_table(spark, M.daily_revenue(o.limit(0)), "t_refresh_test", str(tmp_path / "wh"))
    assert t2.count() == 0


def test_publish_collects_failures(spark, tmp_path, make_orders):
    o = make_orders([("A1", 1, 1.0, ts("2024-01-01 10:00:00"))])
    broken = o.selectExpr("assert_true(false, 'boom') AS x")
    outcomes = WH.publish(
        {"good": M.daily_orders(o), "bad": broken}, str(tmp_path / "pub"), raise_on_error=False
    )
    assert [(x.table_name, x.ok) for x in outcomes] == [("good", True), ("bad", False)]
    with pytest.raises(WH.PublishError):
        WH.publish({"bad": broken}, str(tmp_path / "pub2"))


def test_bronze_reingest_is_idempotent_and_keeps_late_rows(spark, raw_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    B.ingest_orders(spark, raw_dir, bronze)
    B.ingest_orders(spark, raw_dir, bronze, run_date="2024-01-02")   # re-ingest one file
    orders = B.read_bronze_orders(spark, bronze)
    assert orders.count() == 5
    # B2 arrived in the 01-02 file but belongs to 01-01: counted on its own day
    from daymark.plans.daily import restrict_days

    day1 = M.daily_orders(restrict_days(orders, "order_ts", "2024-01-01"))
    assert [(r.orders, r.revenue) for r in day1.collect()] == [(3, 14.0)]
    # files are picked by the days of their rows, so the later file is read for 01-01
    pruned = B.read_bronze_orders(spark, bronze, "2024-01-01")
    assert restrict_days(pruned, "order_ts", "2024-01-01").count() == 3
    # for 01-02 only the second file's folder is read
    read = B.read_bronze_orders(spark, bronze, "2024-01-02").inputFiles()
    assert read and all("/file_date=2024-01-02/" in f for f in read)
    assert B.read_bronze_orders(spark, bronze, "2024-01-02").count() == 2


def test_bronze_events_quarantine(spark, raw_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    res = B.ingest_events(spark, raw_dir, bronze)
    assert res.rows == 4
    assert B.read_bronze_events(spark, bronze).count() == 3
    q = B.read_bronze_quarantine(spark, bronze).collect()
    assert [(r.row_json, r.source_file) for r in q] == [("this is not json", "events_2024-01-01.ndjson")]


def _job_paths(tmp_path, raw_dir):
    return JobPaths(
        raw=raw_dir, bronze=str(tmp_path / "bronze"), silver=str(tmp_path / "silver"),
        users=str(tmp_path / "ref" / "users.csv"),
    )


def test_job_end_to_end_and_run_date(spark, raw_dir, tmp_path):
    paths = _job_paths(tmp_path, raw_dir)
    with pytest.raises(DataQualityError):          # order A3 has no user but passes; amount ok
        bad = JobPaths(**{**paths.__dict__, "users": str(tmp_path / "ref" / "dup.csv")})
        write(bad.users, "user_id,channel\n1,ads\n1,seo\n")
        run_daily_job(spark, bad)
    assert not os.path.exists(tmp_path / "silver" / "daily_orders")   # gate stopped the run

    paths.export = str(tmp_path / "export")
    with pytest.raises(DataQualityError, match="events :: parse"):
        run_daily_job(spark, paths)                         # a line that is no JSON
    assert not os.path.exists(tmp_path / "silver" / "daily_orders")
    paths.warehouse, paths.database = str(tmp_path / "wh"), "daymark_test"
    res = run_daily_job(spark, paths, max_parse_failures=1)
    assert spark.table("daymark_test.fact_daily_orders").count() == 3
    assert {s.table_name for s in res.stages if s.stage == "load"} == set(WAREHOUSE_TABLES.values())
    paths.warehouse = None
    assert res.outputs["daily_orders"].rows == 3            # 01-01, 01-02 and the NULL day
    exported = spark.read.option("header", True).csv(str(tmp_path / "export" / "daily_revenue"))
    assert exported.count() == res.outputs["daily_revenue"].rows
    assert {s.table_name for s in res.stages if s.stage == "export"} == set(res.outputs)
    paths.export = None
    conv = spark.read.parquet(str(tmp_path / "silver" / "daily_conversion"))
    assert sorted((r.date, r.dau, r.buyers) for r in conv.collect()) == [
        (d("2024-01-01"), 2, 3), (d("2024-01-02"), 1, 1)
    ]
    # a run for one date rewrites that date and 01-01, of which its file has a late row
    res2 = run_daily_job(spark, paths, run_date="2024-01-02")
    assert res2.outputs["daily_orders"].rows == 2
    back = spark.read.parquet(str(tmp_path / "silver" / "daily_orders"))
    assert back.count() == 3
    stages = spark.read.parquet(str(tmp_path / "silver" / "_job" / "stage_metrics"))
    assert stages.select("run_id").distinct().count() == 2


def test_job_reuse_of_intermediates_gives_same_tables(spark, raw_dir, tmp_path):
    base = _job_paths(tmp_path, raw_dir)
    other = JobPaths(**{**base.__dict__, "silver": str(tmp_path / "silver2"),
                        "bronze": str(tmp_path / "bronze2")})
    run_daily_job(spark, base, reuse_intermediates=True, max_parse_failures=1)
    run_daily_job(spark, other, reuse_intermediates=False, max_parse_failures=1)
    for name in ("daily_orders", "daily_revenue", "daily_active_users",
                 "daily_active_users_by_channel", "daily_revenue_by_channel", "daily_conversion"):
        a = spark.read.parquet(str(tmp_path / "silver" / name))
        b = spark.read.parquet(str(tmp_path / "silver2" / name)).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_job_with_csv_silver_export_and_publish(spark, raw_dir, tmp_path):
    paths = _job_paths(tmp_path, raw_dir)
    paths.export = str(tmp_path / "export")
    paths.publish = str(tmp_path / "published")
    res = run_daily_job(spark, paths, silver_format="csv", do_publish=True, max_parse_failures=1)
    back = SK.read_back(spark, str(tmp_path / "silver" / "daily_conversion"), S.DAILY_CONVERSION, fmt="csv")
    assert sorted((r.date, r.dau, r.buyers) for r in back.collect()) == [
        (d("2024-01-01"), 2, 3), (d("2024-01-02"), 1, 1)
    ]
    pub = spark.read.format("csv").option("header", True).load(str(tmp_path / "published" / "daily_orders"))
    assert pub.count() == res.outputs["daily_orders"].rows
    assert {s.stage for s in res.stages} >= {"ingest", "quality", "transform", "export", "publish"}


def test_cli_runs_job_and_fails_on_gate(spark, raw_dir, tmp_path, capsys):
    from daymark.cli import main

    cfg = tmp_path / "job.yaml"
    cfg.write_text(
        f"paths: {{raw: {raw_dir}, bronze: {tmp_path / 'b'}, silver: {tmp_path / 's'}, "
        f"users: {tmp_path / 'ref' / 'users.csv'}}}\n"
        "pipeline: {days_back: 1, max_parse_failures: 1}\n"
    )
    assert main(["--config", str(cfg), "--run-date", "2024-01-01"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {x["stage"] for x in lines} >= {"ingest", "quality", "transform"}
    assert all(x["run_date"] == "2024-01-01" for x in lines)
    write(str(tmp_path / "ref" / "dup.csv"), "user_id,channel\n1,ads\n1,seo\n")
    cfg.write_text(cfg.read_text().replace("users.csv", "dup.csv"))
    assert main(["--config", str(cfg)]) == 1


def test_raw_window_pattern_reads_only_window_files(spark, raw_dir):
    pat = FS.raw_window_pattern("orders", dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert pat == "orders_{2024-01-02,2024-01-03}.csv"
    assert FS.raw_window_pattern("orders", dt.date(2024, 1, 2), dt.date(2024, 1, 2)) == "orders_2024-01-02.csv"
    got = read_orders_csv(spark, raw_dir, recursive=True, name_glob=pat)
    assert sorted(r.order_id for r in got.collect()) == ["B1", "B2"]


def test_job_run_date_ingests_only_window_files(spark, raw_dir, tmp_path):
    paths = _job_paths(tmp_path, raw_dir)
    res = run_daily_job(spark, paths, run_date="2024-01-02", days_back=1)
    ingested = {s.table_name: s.rows for s in res.stages if s.stage == "ingest"}
    assert ingested == {"orders": 2, "events": 1}          # only the 01-02 files
    res = run_daily_job(spark, paths, run_date="2024-01-02", days_back=2, max_parse_failures=1)
    ingested = {s.table_name: s.rows for s in res.stages if s.stage == "ingest"}
    assert ingested == {"orders": 5, "events": 4}          # both days' files


def _two_days(tmp_path, first, second):
    root = tmp_path / "raw"
    write(str(root / "orders_2024-01-01.csv"), ORDERS_HEADER + first)
    write(str(root / "orders_2024-01-02.csv"), ORDERS_HEADER + second)
    for day in ("01", "02", "03"):
        write(str(root / f"events_2024-01-{day}.ndjson"), f'{{"event_id":1,"user_id":1,"event_type":"v","ts":"2024-01-{day} 09:00:00"}}\n')
    write(str(tmp_path / "ref" / "users.csv"), "user_id,channel,signup_date\n1,ads,2023-01-01\n")
    return _job_paths(tmp_path, str(root))


def _revenue(spark, tmp_path):
    back = spark.read.parquet(str(tmp_path / "silver" / "daily_orders"))
    return {str(r.order_date): r.revenue for r in back.collect()}


def test_late_rows_count_on_their_own_day(spark, tmp_path):
    paths = _two_days(tmp_path, "A1,1,5.00,2024-01-01 10:00:00\n", "B1,1,1.00,2024-01-02 10:00:00\nA2,1,100.00,2024-01-01 11:00:00\n")
    run_daily_job(spark, paths, run_date="2024-01-01")
    assert _revenue(spark, tmp_path) == {"2024-01-01": 5.0}
    run_daily_job(spark, paths, run_date="2024-01-02")
    assert _revenue(spark, tmp_path) == {"2024-01-01": 105.0, "2024-01-02": 1.0}
    # 01-01 comes again with its only row moved to 01-03: no day keeps rows it has lost.
    write(os.path.join(paths.raw, "orders_2024-01-01.csv"), ORDERS_HEADER + "A1,1,5.00,2024-01-03 10:00:00\n")
    write(os.path.join(paths.raw, "orders_2024-01-02.csv"), ORDERS_HEADER + "B1,1,1.00,2024-01-02 10:00:00\n")
    run_daily_job(spark, paths, run_date="2024-01-02", days_back=2)
    assert _revenue(spark, tmp_path) == {"2024-01-02": 1.0, "2024-01-03": 5.0}


def test_bad_fields_stop_the_run(spark, tmp_path):
    paths = _two_days(tmp_path, "A1,1,5.00,2024-01-01 10:00:00\nA2,2,abc,2024-01-01 10:00:00\nA4\n", "B1,1,NaN,2024-01-02 10:00:00\n")
    with pytest.raises(DataQualityError, match=r"orders :: parse \(2 rows\)"):
        run_daily_job(spark, paths, run_date="2024-01-01")
    with pytest.raises(DataQualityError, match="gt_zero"):
        run_daily_job(spark, paths, run_date="2024-01-02", max_parse_failures=5)
    run_daily_job(spark, paths, run_date="2024-01-01", max_parse_failures=2)
    assert _revenue(spark, tmp_path) == {"2024-01-01": 5.0}
    kept = spark.read.parquet(str(tmp_path / "silver" / "_quality" / "quarantine"))
    assert {r.row_json for r in kept.where("rule = 'parse'").collect()} == {"A2,2,abc,2024-01-01 10:00:00", "A4"}


def test_missing_file_for_the_date(spark, tmp_path):
    paths = _two_days(tmp_path, "A1,1,5.00,2024-01-01 10:00:00\n", "")
    with pytest.raises(FileNotFoundError):
        run_daily_job(spark, paths, run_date="2024-01-05")
    res = run_daily_job(spark, paths, run_date="2024-01-05", allow_empty=True)
    assert {s.table_name: s.rows for s in res.stages if s.stage == "ingest"} == {"orders": 0, "events": 0}


def test_extra_and_reordered_columns_are_read_by_name(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write(os.path.join(raw, "orders_2024-01-01.csv"), "amount,order_id,note,user_id,order_ts\n5.5,A1,hi,7,2024-01-01 10:00:00\n")
    B.ingest_orders(spark, raw, str(tmp_path / "bronze"))
    r = B.read_bronze_orders(spark, str(tmp_path / "bronze")).first()
    assert (r.order_id, r.user_id, r.amount) == ("A1", 7, 5.5)
    # A file of another layout is read by its own header, one that lacks a declared column fails.
    write(os.path.join(raw, "orders_2024-01-02.csv"), ORDERS_HEADER + "A2,1,2.0,2024-01-02 10:00:00\n")
    B.ingest_orders(spark, raw, str(tmp_path / "both"))
    rows = B.read_bronze_orders(spark, str(tmp_path / "both")).collect()
    assert sorted((r.order_id, r.user_id, r.amount) for r in rows) == [("A1", 7, 5.5), ("A2", 1, 2.0)]
    write(os.path.join(raw, "orders_2024-01-03.csv"), "order_id,amount,order_ts\nA3,2.0,2024-01-02 10:00:00\n")
    with pytest.raises(ValueError, match="header lacks user_id"):
        B.ingest_orders(spark, raw, str(tmp_path / "none"))


def test_scale_of_amounts(spark, tmp_path):
    rows = "".join(f"A{i},1,0.004,2024-01-01 10:00:00\n" for i in range(1000))
    paths = _two_days(tmp_path, rows, "")
    run_daily_job(spark, paths, run_date="2024-01-01", scale=3)
    assert _revenue(spark, tmp_path) == {"2024-01-01": 4.0}


def _orders_file(raw, day, lines):
    with open(os.path.join(raw, f"orders_{day}.csv"), "w") as f:
        f.write("order_id,user_id,amount,order_ts\n" + "".join(f"{i},{u},{a},{t}\n" for i, u, a, t in lines))


def test_a_corrected_file_takes_back_what_it_brought(spark, tmp_path):
    """Run date 01-05 twice; the second version of its file dates b a day later and lacks x,
    the only row of 01-02: silver and the published copy follow."""
    raw = str(tmp_path / "raw")
    os.makedirs(raw)
    with open(tmp_path / "users.csv", "w") as f:
        f.write("user_id,channel\n1,web\n2,app\n")
    with open(os.path.join(raw, "events_2024-01-05.ndjson"), "w") as f:
        f.write('{"event_id":1,"user_id":1,"event_type":"v","ts":"2024-01-05 10:00:00"}\n')
    paths = JobPaths(raw=raw, bronze=str(tmp_path / "b"), silver=str(tmp_path / "s"), users=str(tmp_path / "users.csv"), publish=str(tmp_path / "p"))
    _orders_file(raw, "2024-01-05", [("a", 1, 1, "2024-01-05 01:00:00"), ("b", 2, 2, "2024-01-04 01:00:00"), ("x", 2, 9, "2024-01-02 01:00:00")])
    run_daily_job(spark, paths, run_date="2024-01-05", do_publish=True)
    _orders_file(raw, "2024-01-05", [("a", 1, 1, "2024-01-05 01:00:00"), ("b", 2, 2, "2024-01-05 02:00:00")])
    run_daily_job(spark, paths, run_date="2024-01-05", do_publish=True)
    for root in (paths.silver, paths.publish):
        rows = SK.read_back(spark, f"{root}/daily_revenue", S.DAILY_REVENUE).collect()
        assert sorted((str(r.order_date), r.user_id, r.amount) for r in rows) == [("2024-01-05", 1, 1.0), ("2024-01-05", 2, 2.0)], root
    # A full build after the file is gone from bronze's view of that day: the published copy has no day more than silver.
    _orders_file(raw, "2024-01-05", [("a", 1, 1, "2024-01-06 01:00:00")])
    run_daily_job(spark, paths, do_publish=True)
    for root in (paths.silver, paths.publish):
        rows = SK.read_back(spark, f"{root}/daily_orders", S.DAILY_ORDERS).collect()
        assert [(str(r.order_date), r.orders) for r in rows] == [("2024-01-06", 1)], root


def test_only_days_that_a_write_did_not_produce_are_dropped(spark, tmp_path, make_orders):
    """Whatever the folders' times say."""
    path = str(tmp_path / "t")
    schema = S.DAILY_ACTIVE_USERS
    days = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    SK.write_partitioned(spark.createDataFrame([(x, 1) for x in days], schema), path, ["event_date"])
    res = SK.write_partitioned(spark.createDataFrame([(days[0], 5), (None, 7)], schema), path, ["event_date"], list_values=True)
    assert res.values == {"2024-01-01", "__HIVE_DEFAULT_PARTITION__"} and res.rows == 2
    for folder in os.listdir(path):
        if folder.startswith("event_date"):
            os.utime(os.path.join(path, folder), (4e9, 4e9))
    assert SK.drop_partitions(spark, path, "event_date", days[:2], res.values) == ["2024-01-02"]
    rows = SK.read_back(spark, path, schema).collect()
    assert sorted((str(r.event_date), r.dau) for r in rows) == [("2024-01-01", 5), ("2024-01-03", 1), ("None", 7)]
