from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from daymark import schemas as S
from daymark.operators import key_index as K
from daymark.operators.quality import DataQualityError
from daymark.plans import bronze as B
from daymark.plans import incremental as I
from daymark.plans import replay as R
from daymark.plans.job import JobPaths
from daymark.sinks.snapshots import SnapshotStore
from daymark.sources import listing as L

HEADER = "order_id,user_id,amount,order_ts\n"


def order(i, user, amount, ts):
    return f"{i},{user},{amount},{ts}\n"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def event(i, user, ts):
    return json.dumps({"event_id": i, "user_id": user, "event_type": "view", "ts": ts}) + "\n"


@pytest.fixture()
def raw(tmp_path):
    root = str(tmp_path / "raw")
    put(f"{root}/orders_2024-01-04.csv", HEADER + order("a", 1, "10.00", "2024-01-04 10:00:00") + order("b", 2, "5.50", "2024-01-04 11:00:00"))
    put(f"{root}/orders_2024-01-05.csv", HEADER + order("c", 1, "7", "2024-01-05 01:00:00") + order("d", "", "1.25", "2024-01-04 23:59:59") + order("e", 3, "", "2024-01-05 02:00:00"))
    put(f"{root}/x/orders_2024-01-06.csv", "order_ts,amount,note,order_id,user_id\n2024-01-06 00:00:00,3.10,hi,f,2\n,2,no day,g,2\n")
    for day, users in ((4, (1, 2, 2)), (5, (1, 9)), (6, (3, ""))):
        put(f"{root}/events_2024-01-0{day}.ndjson", "".join(event(100 * day + i, u or None, f"2024-01-0{day} 12:00:00") for i, u in enumerate(users)))
    put(str(tmp_path / "users.csv"), "user_id,channel\n1,web\n2,app\n3,web\n")
    return root


def paths_of(tmp_path, raw, name="silver"):
    return JobPaths(raw=raw, bronze=str(tmp_path / f"bronze-{name}"), silver=str(tmp_path / name), users=str(tmp_path / "users.csv"))


def tables(spark, paths):
    return {n: sorted((tuple(r) for r in I.read_table(spark, paths, n).collect()), key=str) for n in S.OUTPUT_SCHEMAS}


def full_build(spark, tmp_path, raw, n):
    """All six tables by the full job, over the files as they are now (one layout at a time)."""
    from daymark.plans.daily import build_metric_tables
    from daymark.sources.csv import read_users_csv, typed_orders
    from daymark.sources.ndjson import read_ndjson, typed_events

    files = [os.path.join(d, f) for d, _, fs in os.walk(raw) for f in fs]
    orders = typed_orders(L.read_csv_layouts(spark, [f for f in files if f.endswith(".csv")], S.ORDERS_RAW))
    events = typed_events(read_ndjson(spark, [f for f in files if f.endswith(".ndjson")], S.EVENTS_RAW))
    built = build_metric_tables(orders.where("_corrupt_record IS NULL"), events, read_users_csv(spark, str(tmp_path / "users.csv")))
    return {name: sorted((tuple(r) for r in t.df.select(*S.OUTPUT_SCHEMAS[name].fieldNames()).collect()), key=str) for name, t in built.items()}


def test_corrected_late_and_unchanged_files(spark, tmp_path, raw):
    paths = paths_of(tmp_path, raw)
    first = I.run_incremental(spark, paths)
    assert first.changed == {"orders": 3, "events": 3} and tables(spark, paths) == full_build(spark, tmp_path, raw, 1)

    # Nothing changed: nothing is ingested, no day restated.
    again = I.run_incremental(spark, paths)
    assert again.changed == {"orders": 0, "events": 0} and again.days == {} and again.snapshot.tables == first.snapshot.tables

    # A corrected file: b goes, d moves to another day, c has another amount, a new order; and a file of late rows.
    put(f"{raw}/orders_2024-01-05.csv", HEADER + order("c", 1, "7.77", "2024-01-05 01:00:00") + order("d", "", "1.25", "2024-01-05 23:59:59") + order("h", 4, "2", "2024-01-03 00:00:00"))
    put(f"{raw}/orders_2024-01-07.csv", HEADER + order("z", 5, "100", "2024-01-04 00:00:01"))
    put(f"{raw}/events_2024-01-06.ndjson", event(600, 3, "2024-01-02 12:00:00"))
    result = I.run_incremental(spark, paths)
    assert result.changed == {"orders": 2, "events": 1}
    ingested = {s.table_name: s.rows for s in result.stages if s.stage == "ingest"}
    assert ingested == {"orders": 4, "events": 1}
    assert {str(d) for d in result.days["orders"]} == {"2024-01-03", "2024-01-04", "2024-01-05"}
    assert tables(spark, paths) == full_build(spark, tmp_path, raw, 2)
    # The day without a changed row keeps its files.
    old, new = (s.snapshot.tables["daily_orders"]["2024-01-06"] for s in (first, result))
    assert old == new

    # An emptied file takes back all it brought, and its days go.
    put(f"{raw}/x/orders_2024-01-06.csv", "order_ts,amount,note,order_id,user_id\n")
    I.run_incremental(spark, paths)
    assert tables(spark, paths) == full_build(spark, tmp_path, raw, 3)
    assert not any(r[0] is None for r in tables(spark, paths)["daily_orders"])

    # Other users: the channel tables of all days follow, no file is read again.
    put(str(tmp_path / "users.csv"), "user_id,channel\n1,shop\n2,app\n3,web\n5,web\n")
    result = I.run_incremental(spark, paths)
    assert result.changed == {"orders": 0, "events": 0} and tables(spark, paths) == full_build(spark, tmp_path, raw, 4)


def test_a_failed_run_leaves_no_trace(spark, tmp_path, raw, monkeypatch):
    paths = paths_of(tmp_path, raw)
    first = I.run_incremental(spark, paths)
    before = tables(spark, paths)
    # The gate stops it: bronze has the rows, no table counts them.
    put(f"{raw}/orders_2024-01-04.csv", HEADER + order("a", 1, "-1", "2024-01-04 10:00:00"))
    with pytest.raises(DataQualityError):
        I.run_incremental(spark, paths)
    assert tables(spark, paths) == before and SnapshotStore(spark, paths.silver).current().version == first.snapshot.version
    # It dies between two tables.
    put(f"{raw}/orders_2024-01-04.csv", HEADER + order("a", 1, "11.5", "2024-01-04 10:00:00"))
    write = I.Transaction.write

    def dies(self, table, *args, **kw):
        if table == "daily_revenue":
            raise KeyboardInterrupt
        return write(self, table, *args, **kw)

    monkeypatch.setattr(I.Transaction, "write", dies)
    with pytest.raises(KeyboardInterrupt):
        I.run_incremental(spark, paths)
    monkeypatch.setattr(I.Transaction, "write", write)
    assert tables(spark, paths) == before
    # The next run takes back what the committed versions brought, not what failed runs read.
    result = I.run_incremental(spark, paths)
    assert result.changed["orders"] == 1 and tables(spark, paths) == full_build(spark, tmp_path, raw, 1)


def test_keys_are_unique_over_all_ingests(spark, tmp_path, raw):
    paths = paths_of(tmp_path, raw)
    I.run_incremental(spark, paths, unique_orders=True)
    # The same file again with the same ids is no duplicate of itself.
    put(f"{raw}/orders_2024-01-04.csv", HEADER + order("a", 1, "10.50", "2024-01-04 10:00:00") + order("b", 2, "5.50", "2024-01-04 11:00:00"))
    I.run_incremental(spark, paths, unique_orders=True)
    put(f"{raw}/orders_2024-01-08.csv", HEADER + order("c", 1, "1", "2024-01-08 10:00:00") + order("n", 1, "1", "2024-01-08 10:00:00") * 2 + order("ok", 1, "1", "2024-01-08 10:00:00"))
    with pytest.raises(DataQualityError) as failed:
        I.run_incremental(spark, paths, unique_orders=True)
    assert failed.value.failures == [("orders", K.RULE, 4)]
    newest = max((os.path.join(tmp_path, "bronze-silver", "_quality", d) for d in os.listdir(tmp_path / "bronze-silver" / "_quality")), key=os.path.getmtime)
    kept = [json.loads(r.row_json) for r in spark.read.parquet(newest).collect()]
    assert sorted(r["order_id"] for r in kept) == ["c", "c", "n", "n"]
    assert [r for r in kept if "source_file" in r] == [{"order_id": "c", "source_file": "orders_2024-01-05.csv", "rows": 1}]
    put(f"{raw}/orders_2024-01-08.csv", HEADER + order("ok", 1, "1", "2024-01-08 10:00:00"))
    # c moves to the new file: its earlier version no longer counts.
    put(f"{raw}/orders_2024-01-05.csv", HEADER + order("ok2", 1, "1", "2024-01-05 10:00:00"))
    put(f"{raw}/orders_2024-01-09.csv", HEADER + order("c", 1, "1", "2024-01-09 10:00:00"))
    I.run_incremental(spark, paths, unique_orders=True)
    assert tables(spark, paths) == full_build(spark, tmp_path, raw, 1)


def test_the_filter_lets_few_keys_to_the_index(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    index = K.KeyIndex(store, "orders", "order_id", bits=1 << 20, buckets=8)
    rows = lambda ids, f: spark.createDataFrame([(i, f, "x") for i in ids], "order_id string, source_file string, ingest_id string")
    for part in range(2):
        t = store.begin()
        index.add(t, rows([f"k{i}" for i in range(part * 2000, part * 2000 + 2000)] + [None], f"f{part}"))
        t.commit()
    t = store.begin()
    new = rows([f"k{i}" for i in range(3990, 8000)] + [None], "g").select(K.F.col("order_id").alias("key"))
    got = {r.key for r in index.possible(new, t).collect()}
    assert {f"k{i}" for i in range(3990, 4000)} | {None} <= got and len(got) < 30
    K.compact_filter(t, index)
    t.commit()
    assert {r.key for r in index.possible(new, store.begin()).collect()} == got


def test_layouts_of_one_folder(spark, tmp_path):
    a, b, c, d = (str(tmp_path / f"{n}.csv") for n in "abcd")
    put(a, HEADER + order("1", 1, "1.5", "2024-01-01 00:00:00"))
    put(b, "﻿amount,\"order_ts\",user_id,order_id\n2.5,2024-01-02 00:00:00,2,2\nbad,2024-01-02 00:00:00,2,3\n")
    put(c, "x,order_id,user_id,amount,order_ts\n-,4,4,4,2024-01-03 00:00:00\n")
    put(d, "")
    rows = L.read_csv_layouts(spark, [a, b, c, d], S.ORDERS_RAW).collect()
    assert sorted((r.order_id, r.user_id, r.amount) for r in rows if r._corrupt_record is None) == [("1", 1, 1.5), ("2", 2, 2.5), ("4", 4, 4.0)]
    assert [r._corrupt_record for r in rows if r._corrupt_record] == ["bad,2024-01-02 00:00:00,2,3"]
    put(d, "order_id,amount\n1,2\n")
    with pytest.raises(ValueError, match="lacks user_id"):
        L.read_csv_layouts(spark, [a, d], S.ORDERS_RAW)


def test_listing_finds_what_changed(spark, tmp_path, raw):
    listed = L.list_files(spark, raw, "orders_*.csv")
    assert sorted(r.source_file for r in listed.collect()) == ["orders_2024-01-04.csv", "orders_2024-01-05.csv", "x/orders_2024-01-06.csv"]
    kept = spark.createDataFrame(listed.collect(), L.LISTING)
    assert L.changed_files(L.list_files(spark, raw, "orders_*.csv"), kept).count() == 0
    put(f"{raw}/orders_2024-01-05.csv", HEADER)
    os.remove(f"{raw}/orders_2024-01-04.csv")
    assert [r.source_file for r in L.changed_files(L.list_files(spark, raw, "orders_*.csv"), kept).collect()] == ["orders_2024-01-05.csv"]
    assert L.list_files(spark, str(tmp_path / "none"), "*").count() == 0


def test_replayed_lines_leave_quarantine_and_reach_the_tables(spark, tmp_path, raw):
    paths = paths_of(tmp_path, raw)
    good = open(f"{raw}/orders_2024-01-05.csv").read()
    bad = good.replace(",7,", ",7 EUR,") + "broken\n"
    put(f"{raw}/orders_2024-01-05.csv", bad)
    I.run_incremental(spark, paths, max_parse_failures=2)
    lines = lambda: sorted(r.row_json for r in B.read_bronze_quarantine(spark, paths.bronze, "orders").collect())
    assert lines() == ["broken", "c,1,7 EUR,2024-01-05 01:00:00"]
    # Raw is not read again: the file is gone.
    os.rename(f"{raw}/orders_2024-01-05.csv", str(tmp_path / "elsewhere.csv"))
    done = R.replay_quarantine(spark, paths.bronze, "orders", lambda text: F.regexp_replace(text, " EUR", ""))
    assert (done.repaired, done.corrupt) == (1, 1) and lines() == ["broken"]
    result = I.run_incremental(spark, paths, replayed={"orders": done.ingest_id}, max_parse_failures=2)
    assert result.changed["orders"] == 0 and [str(d) for d in result.days["orders"]] == ["2024-01-05"]
    put(f"{raw}/orders_2024-01-05.csv", good)
    assert tables(spark, paths) == full_build(spark, tmp_path, raw, 1)
    assert R.replay_quarantine(spark, paths.bronze, "orders", lambda text: F.lit("y,1,2,2024-01-05 00:00:00")).repaired == 1 and lines() == []
    assert R.replay_quarantine(spark, paths.bronze, "orders", lambda text: text).ingest_id is None
    # The file itself comes again and replaces the replays.
    assert I.run_incremental(spark, paths).changed["orders"] == 1
    assert tables(spark, paths) == full_build(spark, tmp_path, raw, 1)
    events = spark.createDataFrame([('{"event_id":1,"user_id":2,"event_type":"v","ts":"2024-01-01 00:00:00"}',), ("{",)], "line string")
    got = {r._corrupt_record: (r.event_id, str(r.ts)) for r in R.parse_lines(events, "events", "line").collect()}
    assert got == {None: (1, "2024-01-01 00:00:00"), "{": (None, "None")}
