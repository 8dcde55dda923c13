"""Purchases without a positive value: the queries made of them count such rows as their SQL does,
the gate reports them and still stops at what breaks another rule."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

from daymark.operators import quality as DQ
from daymark.plans import catalog_io as C
from daymark.plans import incremental as I
from daymark.plans.catalog import ORACLE_SQL, QUERIES
from daymark.plans.job import JobPaths, run_daily_job
from tests.conftest import ts
from tests.test_oracle import _digest

NAMES = [
    "gated_publish", "daily_job_run_date", "incremental_tables", "unique_over_ingests",
    *[f"job_{n}" for n in C.WAREHOUSE_TABLES], *[f"warehouse_{t}" for t in C.WAREHOUSE_TABLES.values()],
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Purchases of two weeks, some with a value of 0, one of them in the run date's window; users 0 to 4."""
    root = str(tmp_path_factory.mktemp("zero"))
    rows = []
    for i in range(1, 121):
        kind = "purchase" if i % 3 else "view"
        value = 0.0 if i in (20, 40, 61) else 1.25 * i
        at = dt.datetime(2024, 1, 5) + dt.timedelta(hours=3 * i)
        rows.append((i, at, i % 6, kind, value if kind == "purchase" else None, '{"k": 1}'))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{root}/events.parquet")
    users = [(i, "ABC"[i % 3]) for i in range(5)]
    spark.createDataFrame(users, "c_custkey long, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    return root


@pytest.mark.parametrize("name", NAMES)
def test_zero_values_are_counted(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet/*.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert rows and _digest(rows, df.columns) == _digest(cur.fetchall(), cols)


def test_a_warning_stops_nothing(make_orders, make_users):
    rules = [DQ.Rule("orders", "amount", "gt_zero", severity="warn"), *DQ.DEFAULT_RULES[::2]]
    tables = {"orders": make_orders([("A1", 1, 0.0, None), ("A2", 2, 1.0, None)]), "users": make_users([(1, "a"), (2, "b")])}
    checked = DQ.gate(DQ.rule_summary(tables, rules), rules)
    assert ("orders", "gt_zero(amount)", 2) in checked and len(checked) == 3
    assert [r.rule for r in DQ.quarantine(tables, rules).collect()] == ["gt_zero(amount)"]
    with pytest.raises(DQ.DataQualityError):     # an error of the same rule is one
        DQ.gate(DQ.rule_summary(tables, rules), [*rules, *DQ.DEFAULT_RULES])
    tables["users"] = make_users([(1, "a"), (1, "b")])
    with pytest.raises(DQ.DataQualityError) as err:
        DQ.gate(DQ.rule_summary(tables, rules), rules)
    assert [f[1] for f in err.value.failures] == ["unique(user_id)"]


def test_severity_of_rules():
    section = {"orders": [{"column": "amount", "check": "gt_zero", "severity": "warn"}, {"column": "order_id", "check": "not_null"}]}
    assert [r.severity for r in DQ.rules_from_config(section)] == ["warn", "error"]
    with pytest.raises(ValueError):
        DQ.Rule("orders", "amount", "gt_zero", severity="info")


@pytest.mark.parametrize("run", [run_daily_job, I.run_incremental])
def test_runs_with_the_default_rules_still_stop(spark, tmp_path, make_orders, run):
    orders = make_orders([("A1", 1, 0.0, ts("2024-01-01 10:00:00")), ("A2", 1, 2.0, ts("2024-01-01 11:00:00"))])
    raw, users = str(tmp_path / "raw"), str(tmp_path / "users.csv")
    C.ST.stage_named_files(C.ST.raw_orders_frame(orders), raw, "csv", {None: "orders_2024-01-01.csv"})
    C.ST.stage_named_files(C.ST.raw_events_frame(spark, _one_event(spark, tmp_path)).drop("day"), raw, "json", {None: "events_2024-01-01.ndjson"})
    (tmp_path / "users.csv").write_text("user_id,channel\n1,web\n")
    paths = lambda name: JobPaths(raw=raw, bronze=str(tmp_path / name / "bronze"), silver=str(tmp_path / name / "silver"), users=users)
    with pytest.raises(DQ.DataQualityError, match="gt_zero"):
        run(spark, paths("default"))
    checked = run(spark, paths("warned"), rules=C.PURCHASE_RULES).quality
    assert ("orders", "gt_zero(amount)", 2) in checked


def _one_event(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1), 1, "view", None, "{}")]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/sf/events.parquet")
    return f"{tmp_path}/sf"
