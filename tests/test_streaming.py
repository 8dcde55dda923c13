"""Incremental raw → bronze ingest with a file-source stream."""

from __future__ import annotations

import os

from daymark.plans import bronze as B
from daymark.streaming.ingest import ingest_stream


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_stream_picks_up_only_new_files(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    header = "order_id,user_id,amount,order_ts\n"
    write(f"{raw}/orders_2024-01-01.csv", header + "A1,1,5.00,2024-01-01 10:00:00\nA2,2,1.00,2024-01-01 11:00:00\n")
    first = ingest_stream(spark, "orders", raw, bronze)
    assert first.rows == 2
    write(f"{raw}/orders_2024-01-02.csv", header + "B1,1,2.00,2024-01-02 10:00:00\n")
    second = ingest_stream(spark, "orders", raw, bronze)
    assert second.rows == 1                       # the first file is not read again
    again = ingest_stream(spark, "orders", raw, bronze)
    assert again.rows == 0
    got = B.read_bronze_orders(spark, bronze)
    assert sorted(r.order_id for r in got.collect()) == ["A1", "A2", "B1"]
    dates = {r.file_date.isoformat() for r in spark.read.parquet(f"{bronze}/orders/data").collect()}
    assert dates == {"2024-01-01", "2024-01-02"}


def test_stream_events_keep_corrupt_lines(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    write(f"{raw}/events_2024-01-01.ndjson",
          '{"event_id":1,"user_id":1,"event_type":"view","ts":"2024-01-01 09:00:00"}\n'
          "{broken\n")
    res = ingest_stream(spark, "events", raw, bronze)
    assert res.rows == 2
    assert B.read_bronze_events(spark, bronze).count() == 1
    assert [r.row_json for r in B.read_bronze_quarantine(spark, bronze).collect()] == ["{broken"]


def test_same_file_names_one_file_a_batch(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    header = "order_id,user_id,amount,order_ts\n"
    for n, folder in enumerate(("a", "b")):
        write(f"{raw}/{folder}/orders_2024-01-01.csv", header + f"X{n},1,5.00,2024-01-01 10:00:00\n")
    res = ingest_stream(spark, "orders", raw, bronze, max_files_per_trigger=1)
    assert (res.batches, res.rows) == (2, 2)
    assert sorted(r.order_id for r in B.read_bronze_orders(spark, bronze).collect()) == ["X0", "X1"]
