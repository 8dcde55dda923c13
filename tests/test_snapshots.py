from __future__ import annotations

import datetime as dt
import os

import pytest

from daymark import schemas as S
from daymark.sinks.snapshots import NULL_PARTITION, CommitConflict, SnapshotStore

DAU = S.DAILY_ACTIVE_USERS
D1, D2, D3 = (dt.date(2024, 1, i) for i in (1, 2, 3))


def frame(spark, rows):
    return spark.createDataFrame(rows, DAU)


def rows_of(store, table="dau", **kw):
    return sorted(((r[0], r[1]) for r in store.read(table, DAU, **kw).collect()), key=lambda r: (r[0] is None, str(r)))


def test_a_commit_shows_all_tables_or_none(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    assert store.current().version == 0 and rows_of(store) == []
    t = store.begin()
    t.write("dau", frame(spark, [(D1, 1), (D2, 2), (None, 9)]), "event_date")
    t.write("other", frame(spark, [(D1, 10)]), "event_date")
    assert rows_of(store) == [] and store.versions() == []
    t.commit({"run": "a"})
    assert rows_of(store) == [(D1, 1), (D2, 2), (None, 9)] and rows_of(store, values=[D2, None, D3]) == [(D2, 2), (None, 9)]

    # A job that dies after its first table: nothing of it is seen.
    dead = store.begin()
    dead.write("dau", frame(spark, [(D1, 100)]), "event_date", values=[D1, D2])
    assert rows_of(store) == [(D1, 1), (D2, 2), (None, 9)] and rows_of(store, "other") == [(D1, 10)]

    # The next one replaces two days, one of which has no rows any more.
    t = store.begin()
    new = t.write("dau", frame(spark, [(D1, 5), (D3, 7)]), "event_date", values=[D1, D2])
    assert set(new) == {"2024-01-01"}
    done = t.commit()
    assert rows_of(store) == [(D1, 5), (None, 9)] and done.meta == {"run": "a"} and rows_of(store, "other") == [(D1, 10)]
    assert rows_of(store, snapshot=store.snapshot(1)) == [(D1, 1), (D2, 2), (None, 9)]
    with pytest.raises(CommitConflict):
        dead.commit()
    assert rows_of(store) == [(D1, 5), (None, 9)]


def test_digests_tell_content_not_files(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    many = [(D1, i) for i in range(100)] + [(None, 3)]
    t = store.begin()
    a = t.write("a", frame(spark, many).repartition(7), "event_date")
    b = t.write("b", frame(spark, many[::-1]), "event_date", layout="none")
    c = t.write("c", frame(spark, many[1:]), "event_date")
    assert {v: (p.rows, p.digest) for v, p in a.items()} == {v: (p.rows, p.digest) for v, p in b.items()}
    assert a["2024-01-01"].digest != c["2024-01-01"].digest and a[NULL_PARTITION].digest == c[NULL_PARTITION].digest


def test_append_and_vacuum(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    for i in range(4):
        t = store.begin()
        t.write("log", frame(spark, [(D1, i)]), "event_date", append=True)
        t.write("last", frame(spark, [(D1, i)]), "event_date")
        if i == 1:
            dead = store.begin()
            dead.write("last", frame(spark, [(D2, 50)]), "event_date")
        t.commit()
    working = store.begin()
    working.write("last", frame(spark, [(D1, 99)]), "event_date")
    assert rows_of(store, "log") == [(D1, i) for i in range(4)]
    dropped = store.vacuum(keep=2)
    # Two old commits of "last" and the dead one; the log is still named, the one at work is left.
    assert len(dropped) == 3 and all(d.startswith("last/") for d in dropped)
    assert store.versions() == [3, 4] and rows_of(store, "log") == [(D1, i) for i in range(4)] and rows_of(store, "last") == [(D1, 3)]
    assert rows_of(store, "last", snapshot=store.snapshot(3)) == [(D1, 2)]
    working.commit()
    assert rows_of(store, "last") == [(D1, 99)]


def test_only_the_wanted_folders_are_read(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    t = store.begin()
    t.write("dau", frame(spark, [(dt.date(2024, 1, i), i) for i in range(1, 29)]), "event_date")
    t.commit()
    files = store.read("dau", DAU, values=[D2]).inputFiles()
    assert files and all("event_date=2024-01-02" in f for f in files)
    assert os.path.isdir(tmp_path / "s" / "commits")
