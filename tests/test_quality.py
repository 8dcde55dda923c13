"""Quality rules: flagged rows, quarantine, summary and gate."""

from __future__ import annotations

import json

import pytest

from daymark.operators import quality as DQ
from tests.conftest import ts


def test_unique_flags_every_member_and_null_keys(make_users):
    u = make_users([(1, "ads"), (1, "seo"), (2, "ads"), (None, "x"), (None, "y")])
    bad = DQ.violations(u, DQ.Rule("users", "user_id", "unique"))
    assert sorted(((r.user_id, r.channel) for r in bad.collect()), key=repr) == sorted(
        [(1, "ads"), (1, "seo"), (None, "x"), (None, "y")], key=repr
    )


def test_single_null_key_is_not_a_duplicate(make_users):
    u = make_users([(1, "ads"), (None, "x")])
    assert DQ.violations(u, DQ.Rule("users", "user_id", "unique")).count() == 0


def test_gt_zero_flags_zero_and_negative_not_null(make_orders):
    o = make_orders([
        ("A1", 1, 0.0, ts("2024-01-01 10:00:00")),
        ("A2", 1, -1.0, ts("2024-01-01 10:00:00")),
        ("A3", 1, None, ts("2024-01-01 10:00:00")),
        ("A4", 1, 3.0, ts("2024-01-01 10:00:00")),
    ])
    bad = DQ.violations(o, DQ.Rule("orders", "amount", "gt_zero"))
    assert sorted(r.order_id for r in bad.collect()) == ["A1", "A2"]


def test_not_null(make_orders):
    o = make_orders([(None, 1, 1.0, None), ("A2", 1, 1.0, None)])
    bad = DQ.violations(o, DQ.Rule("orders", "order_id", "not_null"))
    assert [r.user_id for r in bad.collect()] == [1]


def test_quarantine_rows_keep_null_fields(make_orders, make_users):
    o = make_orders([(None, 1, -2.0, ts("2024-01-01 10:00:00"))])
    u = make_users([(3, "a"), (3, "b")])
    q = DQ.quarantine({"orders": o, "users": u}, DQ.DEFAULT_RULES).collect()
    got = sorted((r.table_name, r.rule) for r in q)
    assert got == [
        ("orders", "gt_zero(amount)"),
        ("orders", "not_null(order_id)"),
        ("users", "unique(user_id)"),
        ("users", "unique(user_id)"),
    ]
    row = json.loads(next(r.row_json for r in q if r.rule == "not_null(order_id)"))
    assert row["order_id"] is None and row["amount"] == -2.0


def test_summary_and_gate(make_orders, make_users):
    o = make_orders([
        ("A1", 1, 1.0, None), ("A2", 2, 0.0, None), (None, 3, 2.0, None),
    ])
    u = make_users([(1, "a"), (2, "b")])
    summary = DQ.rule_summary({"orders": o, "users": u}, DQ.DEFAULT_RULES)
    got = {(r.table_name, r.rule): (r.rows_checked, r.violations, r.ok) for r in summary.collect()}
    assert got == {
        ("orders", "not_null(order_id)"): (3, 1, False),
        ("orders", "gt_zero(amount)"): (3, 1, False),
        ("users", "unique(user_id)"): (2, 0, True),
    }
    with pytest.raises(DQ.DataQualityError) as err:
        DQ.gate(summary)
    assert {f[1] for f in err.value.failures} == {"not_null(order_id)", "gt_zero(amount)"}


def test_gate_passes_clean_input(make_orders, make_users):
    o = make_orders([("A1", 1, 1.0, None)])
    u = make_users([(1, "a")])
    checked = DQ.gate(DQ.rule_summary({"orders": o, "users": u}, DQ.DEFAULT_RULES))
    assert len(checked) == 3


def test_rules_from_config():
    rules = DQ.rules_from_config({
        "orders": [{"name": "non_null_order_id", "column": "order_id", "check": "not_null"}],
        "users": [{"name": "u", "column": "user_id", "check": "unique"}],
    })
    assert [r.label for r in rules] == ["not_null(order_id)", "unique(user_id)"]
    with pytest.raises(ValueError):
        DQ.Rule("t", "c", "positive")


def test_unique_on_hot_key_is_exact(spark):
    """One key holding a third of the rows is flagged in full."""
    from pyspark.sql import functions as F

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("k"),
        "id",
    )
    bad = DQ.violations(df, DQ.Rule("t", "k", "unique"))
    assert bad.count() == 1000


def test_run_summary(make_orders, make_users):
    o = make_orders([("A1", 1, 1.0, None), ("A2", 2, 0.0, None)])
    u = make_users([(1, "a"), (1, "b")])
    summary = DQ.rule_summary({"orders": o, "users": u}, DQ.DEFAULT_RULES)
    r = DQ.run_summary(summary).collect()[0]
    assert (r.rules_run, r.failed_rules, r.violations, r.passed) == (3, 2, 3, False)


def test_observed_quarantine_matches_separate_passes(spark, make_orders, make_users):
    o = make_orders([
        (None, 1, -1.0, None),             # fails two rules → two records
        ("A2", 2, 0.0, None),
        ("A3", 3, 5.0, None),
    ])
    u = make_users([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")])
    tables = {"orders": o, "users": u}
    frame, results = DQ.observed_quarantine(tables, DQ.DEFAULT_RULES)
    got = sorted((r.table_name, r.rule, r.row_json) for r in frame.collect())
    want = sorted((r.table_name, r.rule, r.row_json) for r in DQ.quarantine(tables, DQ.DEFAULT_RULES).collect())
    assert got == want and len(got) == 7
    summary = {(r.table_name, r.rule): (r.rows_checked, r.violations)
               for r in DQ.rule_summary(tables, DQ.DEFAULT_RULES).collect()}
    assert {(t, r): (n, v) for t, r, n, v in results()} == summary
    with pytest.raises(DQ.DataQualityError):
        DQ.gate_results(results())


def test_observed_quarantine_on_empty_input(spark, make_orders, make_users):
    frame, results = DQ.observed_quarantine(
        {"orders": make_orders([]), "users": make_users([])}, DQ.DEFAULT_RULES
    )
    assert frame.count() == 0
    assert sorted(results()) == [
        ("orders", "gt_zero(amount)", 0, 0),
        ("orders", "not_null(order_id)", 0, 0),
        ("users", "unique(user_id)", 0, 0),
    ]
