from __future__ import annotations

import datetime as dt
import os

import pytest

from daymark import schemas as S
from daymark.plans import bronze as B
from daymark.plans import incremental as I
from daymark.plans import maintenance as X
from daymark.plans.job import JobPaths
from daymark.sinks import warehouse as WH
from daymark.sinks.snapshots import SnapshotStore

HEADER = "order_id,user_id,amount,order_ts\n"
NOW = dt.timedelta(0)


def put(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(HEADER + "".join(f"{i},{u},{a},{t}\n" for i, u, a, t in lines))


def day_file(raw, day, lines):
    put(os.path.join(raw, f"orders_2024-01-0{day}.csv"), lines)


def rows(spark, bronze):
    clean = sorted(tuple(r) for r in B.read_bronze_orders(spark, bronze).collect())
    bad = sorted(tuple(r) for r in B.read_bronze_quarantine(spark, bronze, "orders").collect())
    return clean, bad


def data_files(bronze):
    return sum(f.endswith(".parquet") for d, _, fs in os.walk(os.path.join(bronze, "orders", "data")) for f in fs)


def test_compaction_keeps_the_rows_and_later_versions_win(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "b")
    for day in (1, 2, 3, 4):
        day_file(raw, day, [(f"a{day}", 1, day, f"2024-01-0{day} 10:00:00"), (f"b{day}", 2, "x" if day == 2 else 5, f"2024-01-0{day - 1 or 1} 23:00:00")])
        B.ingest_orders(spark, raw, bronze, f"2024-01-0{day}")
    day_file(raw, 3, [("a3", 1, 33, "2024-01-03 10:00:00")])
    B.ingest_orders(spark, raw, bronze, "2024-01-03")
    before, many = rows(spark, bronze), data_files(bronze)
    assert X.vacuum_bronze(spark, bronze, "orders") == []
    done = X.compact_bronze(spark, bronze, "orders")
    assert done.files == 4 and done.rows == 7 and rows(spark, bronze) == before
    # Everything but the compaction is replaced; the retention time holds it back first.
    assert X.vacuum_bronze(spark, bronze, "orders", older_than=dt.timedelta(days=1)) == []
    gone = X.vacuum_bronze(spark, bronze, "orders", older_than=NOW)
    assert len(gone) == 5 and rows(spark, bronze) == before and data_files(bronze) < many
    assert X.compact_bronze(spark, bronze, "orders").ingest_id is None
    # A file that comes again replaces its rows in the compaction, also one that was read before it was listed.
    day_file(raw, 1, [("a1", 1, 11, "2024-01-01 10:00:00")])
    B.ingest_orders(spark, raw, bronze, "2024-01-01")
    clean, bad = rows(spark, bronze)
    assert [r for r in clean if r[0] in ("a1", "b1")] == [("a1", 1, 11.0, dt.datetime(2024, 1, 1, 10))] and bad == before[1]
    second = X.compact_bronze(spark, bronze, "orders")
    assert second.files == 4 and rows(spark, bronze) == (clean, bad)


def test_an_ingest_during_a_compaction_wins(spark, tmp_path, monkeypatch):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "b")
    for day in (1, 2):
        day_file(raw, day, [(f"a{day}", 1, 1, f"2024-01-0{day} 10:00:00")])
        B.ingest_orders(spark, raw, bronze, f"2024-01-0{day}")
    list_ingest = B.list_ingest

    def slow(*args, **kw):
        if len(args) > 4:
            monkeypatch.setattr(B, "list_ingest", list_ingest)
            day_file(raw, 1, [("new", 1, 1, "2024-01-01 10:00:00")])
            B.ingest_orders(spark, raw, bronze, "2024-01-01")
        return list_ingest(*args, **kw)

    monkeypatch.setattr(B, "list_ingest", slow)
    X.compact_bronze(spark, bronze, "orders")
    assert [r[0] for r in rows(spark, bronze)[0]] == ["a2", "new"]


def test_incremental_runs_take_rows_back_from_compactions(spark, tmp_path):
    raw = str(tmp_path / "raw")
    with open(tmp_path / "users.csv", "w") as f:
        f.write("user_id,channel\n1,web\n")
    paths = JobPaths(raw_orders=raw, bronze=str(tmp_path / "b"), silver=str(tmp_path / "s"), users=str(tmp_path / "users.csv"), publish=str(tmp_path / "p"))
    for day in (1, 2, 3):
        day_file(raw, day, [(f"a{day}", 1, day, f"2024-01-0{day} 10:00:00"), (f"b{day}", 1, 5, f"2024-01-0{day} 10:00:00")])
        I.run_incremental(spark, paths, do_publish=True)
    X.compact_bronze(spark, paths.bronze, "orders")
    assert len(X.vacuum_bronze(spark, paths.bronze, "orders", older_than=NOW)) == 3
    day_file(raw, 2, [("a2", 1, 20, "2024-01-02 10:00:00")])
    day_file(raw, 3, [("a3", 1, 3, "2024-01-02 10:00:00")])
    I.run_incremental(spark, paths, do_publish=True)
    want = [("2024-01-01", 2, 1, 6.0), ("2024-01-02", 2, 1, 23.0)]
    published = SnapshotStore(spark, paths.publish).read("daily_orders", S.DAILY_ORDERS)
    for df in (I.read_table(spark, paths, "daily_orders"), published):
        assert sorted((str(r.order_date), r.orders, r.buyers, r.revenue) for r in df.collect()) == want


def test_a_run_date_opens_only_files_with_rows_of_its_days(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "b")
    # One ingest of many files of one date; each file has one day of a wide range.
    for i in range(1, 7):
        put(f"{raw}/p{i}/orders_2024-01-09.csv", [(f"o{i}", 1, 1, f"2024-01-0{i} 10:00:00")])
    B.ingest_orders(spark, raw, bronze)
    everything = B.read_bronze_orders(spark, bronze).inputFiles()
    read = B.read_bronze_orders(spark, bronze, "2024-01-03", days_back=2)
    assert len(read.inputFiles()) < len(everything) and {"o2", "o3"} <= {r.order_id for r in read.collect()}
    per_day = spark.read.schema(B.FILE_DAYS_SCHEMA).parquet(f"{bronze}/orders/file_days")
    wanted = {r.data_file for r in per_day.where("day BETWEEN DATE '2024-01-02' AND DATE '2024-01-03'").collect()}
    assert {f.split("ingest_id=")[1].split("/", 1)[1] for f in read.inputFiles()} == wanted
    assert B.read_bronze_orders(spark, bronze, "2024-02-01").count() == 0


def test_publish_copies_what_differs(spark, tmp_path):
    source, target = SnapshotStore(spark, str(tmp_path / "s")), SnapshotStore(spark, str(tmp_path / "t"))
    schemas = {"daily_active_users": S.DAILY_ACTIVE_USERS, "daily_orders": S.DAILY_ORDERS}
    days = [dt.date(2024, 1, i) for i in range(1, 5)]

    def commit(dau):
        t = source.begin()
        t.write("daily_active_users", spark.createDataFrame(dau, S.DAILY_ACTIVE_USERS), "event_date")
        t.write("daily_orders", spark.createDataFrame([(days[0], 1, 1, 2.5)], S.DAILY_ORDERS), "order_date")
        t.commit()

    read = lambda store: sorted((str(r.event_date), r.dau) for r in store.read("daily_active_users", S.DAILY_ACTIVE_USERS).collect())
    commit([(d, 10) for d in days] + [(None, 1)])
    first = WH.publish_changes(source, target, schemas)
    assert [(p.table_name, len(p.copied), p.rows_written) for p in first] == [("daily_active_users", 5, 5), ("daily_orders", 1, 1)] and read(target) == read(source)
    version = target.current().version
    WH.publish_changes(source, target, schemas)
    assert target.current().version == version
    # One day corrected, one gone: the rest is not written again, though its files are new at the source.
    commit([(days[0], 10), (days[1], 99), (days[2], 10), (None, 1)])
    (dau, orders) = WH.publish_changes(source, target, schemas)
    assert (dau.copied, dau.removed, dau.unchanged, dau.rows_written) == (("2024-01-02",), ("2024-01-04",), 3, 1) and orders.copied == ()
    assert read(target) == read(source)
    # A table that can't be written leaves the target as it was.
    commit([(days[0], 1)])
    t = source.begin()
    t.tables["daily_orders"] = {"2024-01-01": t.tables["daily_orders"]["2024-01-01"].__class__(("nowhere/order_date=2024-01-01",), 1, "other")}
    t.commit()
    before = read(target)
    with pytest.raises(WH.PublishError) as failed:
        WH.publish_changes(source, target, schemas)
    assert set(failed.value.failed) == {"daily_orders"} and read(target) == before


def test_a_refresh_switches_the_table_at_its_end(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "w"), "staged_" + os.path.basename(tmp_path)
    frame = lambda n: spark.createDataFrame([(dt.date(2024, 1, 1), i) for i in range(n)], S.DAILY_ACTIVE_USERS)
    assert WH.staged_refresh(spark, frame(3), table, path) == 3 and spark.table(table).count() == 3
    # It stops after the files are written.
    monkeypatch.setattr(WH, "_location", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        WH.staged_refresh(spark, frame(5), table, path)
    monkeypatch.undo()
    assert spark.table(table).count() == 3
    for n in (4, 2):
        assert WH.staged_refresh(spark, frame(n), table, path) == n and spark.table(table).count() == n
    # The live folder and the one before it stay.
    assert len([f for f in os.listdir(path) if f.startswith("load-")]) == 2
    assert WH.staged_refresh(spark, frame(2), table, path, text_columns=True) == 2
    assert {t for _, t in spark.table(table).dtypes} == {"string"}
    spark.sql(f"DROP TABLE {table}")
