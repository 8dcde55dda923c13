"""Edge cases of the six daily tables on literal rows."""

from __future__ import annotations

from daymark.operators import metrics as M
from daymark.plans.daily import build_metric_tables, restrict_days
from tests.conftest import d, ts


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def srt(expected):
    return sorted(expected, key=repr)


def test_duplicate_order_id_same_day_counts_once(make_orders):
    o = make_orders([
        ("A1", 1, 5.00, ts("2024-01-01 10:00:00")),
        ("A1", 1, 7.00, ts("2024-01-01 11:00:00")),
    ])
    assert rows(M.daily_orders(o), "order_date", "orders", "buyers", "revenue") == [
        (d("2024-01-01"), 1, 1, 12.0)
    ]


def test_null_user_counted_in_orders_and_revenue_not_buyers(make_orders):
    o = make_orders([
        ("A1", None, 5.00, ts("2024-01-01 10:00:00")),
        ("A2", 7, 1.25, ts("2024-01-01 12:00:00")),
    ])
    assert rows(M.daily_orders(o), "orders", "buyers", "revenue") == [(2, 1, 6.25)]
    assert rows(M.daily_revenue(o), "user_id", "amount") == srt([(7, 1.25), (None, 5.0)])


def test_null_timestamp_is_its_own_day_without_run_date(make_orders):
    o = make_orders([
        ("A1", 1, 5.00, None),
        ("A2", 1, 2.00, ts("2024-01-01 10:00:00")),
    ])
    assert rows(M.daily_orders(o), "order_date", "orders") == srt([
        (d("2024-01-01"), 1), (None, 1)
    ])
    only = restrict_days(o, "order_ts", "2024-01-01")
    assert rows(M.daily_orders(only), "order_date", "orders") == [(d("2024-01-01"), 1)]


def test_money_is_summed_exactly(make_orders):
    o = make_orders([("A%d" % i, 1, 0.1, ts("2024-01-01 10:00:00")) for i in range(10)])
    assert rows(M.daily_orders(o), "revenue") == [(1.0,)]


def test_unmatched_user_falls_under_null_channel(make_orders, make_users):
    o = make_orders([
        ("A1", 1, 5.00, ts("2024-01-01 10:00:00")),
        ("A2", 99, 3.00, ts("2024-01-01 10:00:00")),
    ])
    u = make_users([(1, "ads")])
    got = rows(M.daily_revenue_by_channel(o, u), "order_date", "channel", "revenue")
    assert got == srt([(d("2024-01-01"), "ads", 5.0), (d("2024-01-01"), None, 3.0)])


def test_null_user_event_alone_on_a_day(make_events, make_users, make_orders):
    e = make_events([(1, None, "view", ts("2024-01-02 09:00:00"))])
    u = make_users([(1, "ads")])
    assert rows(M.daily_active_users(e), "event_date", "dau") == [(d("2024-01-02"), 0)]
    assert rows(M.daily_active_users_by_channel(e, u), "event_date", "channel", "dau") == [
        (d("2024-01-02"), None, 0)
    ]
    conv = M.daily_conversion(e, make_orders([]))
    assert rows(conv, "date", "dau", "buyers", "conv_rate") == [(d("2024-01-02"), 0, 0, None)]


def test_conversion_days_and_rates(make_events, make_orders):
    e = make_events([
        (1, 1, "view", ts("2024-01-01 09:00:00")),
        (2, 2, "view", ts("2024-01-01 09:30:00")),
        (3, 1, "view", ts("2024-01-02 09:00:00")),
        (4, 1, "view", ts("2024-01-03 09:00:00")),
    ])
    o = make_orders([
        ("A1", 1, 5.0, ts("2024-01-01 10:00:00")),         # 1 buyer / 2 active
        ("A2", 1, 5.0, ts("2024-01-03 10:00:00")),         # 3 buyers / 1 active
        ("A3", 5, 5.0, ts("2024-01-03 10:00:00")),
        ("A4", 6, 5.0, ts("2024-01-03 10:00:00")),
        ("A5", 1, 5.0, ts("2024-01-04 10:00:00")),         # orders, no events
    ])
    got = rows(M.daily_conversion(e, o), "date", "dau", "buyers", "conv_rate")
    assert got == [
        (d("2024-01-01"), 2, 1, 0.5),
        (d("2024-01-02"), 1, 0, 0.0),
        (d("2024-01-03"), 1, 3, 3.0),
    ]
    raw = rows(M.daily_conversion(e, o, round_to=None), "date", "conv_rate")
    assert raw[0] == (d("2024-01-01"), 0.5)


def test_conversion_rounds_to_four_places(make_events, make_orders):
    e = make_events([(i, i, "view", ts("2024-01-01 09:00:00")) for i in range(3)])
    o = make_orders([("A1", 0, 1.0, ts("2024-01-01 10:00:00"))])
    assert rows(M.daily_conversion(e, o), "conv_rate") == [(0.3333,)]
    assert rows(M.daily_conversion(e, o, round_to=None), "conv_rate") == [(1 / 3,)]


def test_duplicate_user_fans_revenue_out(make_orders, make_users):
    o = make_orders([("A1", 1, 5.0, ts("2024-01-01 10:00:00"))])
    u = make_users([(1, "ads"), (1, "seo")])
    got = rows(M.daily_revenue_by_channel(o, u), "channel", "revenue")
    assert got == [("ads", 5.0), ("seo", 5.0)]


def test_revenue_by_channel_from_written_revenue_matches(make_orders, make_users):
    o = make_orders([
        ("A1", 1, 5.0, ts("2024-01-01 10:00:00")),
        ("A2", 1, 2.5, ts("2024-01-01 11:00:00")),
        ("A3", 2, 1.0, ts("2024-01-02 10:00:00")),
        ("A4", None, 4.0, ts("2024-01-02 10:00:00")),
    ])
    u = make_users([(1, "ads"), (2, "seo")])
    direct = rows(M.daily_revenue_by_channel(o, u), "order_date", "channel", "revenue")
    via = rows(
        M.daily_revenue_by_channel(None, u, revenue=M.daily_revenue(o)),
        "order_date", "channel", "revenue",
    )
    assert direct == via


def test_active_user_days_distinct(make_events):
    e = make_events([
        (1, 1, "view", ts("2024-01-01 09:00:00")),
        (2, 1, "click", ts("2024-01-01 19:00:00")),
        (3, None, "view", ts("2024-01-01 19:00:00")),
        (4, None, "view", ts("2024-01-01 20:00:00")),
    ])
    assert rows(M.active_user_days(e), "event_date", "user_id") == srt([
        (d("2024-01-01"), 1), (d("2024-01-01"), None)
    ])


def test_lookback_window_is_inclusive(make_orders):
    o = make_orders([
        ("A%d" % i, 1, 1.0, ts(f"2024-01-{i:02d} 10:00:00")) for i in range(1, 11)
    ])
    got = restrict_days(o, "order_ts", "2024-01-10", days_back=7)
    assert sorted(r["order_id"] for r in got.collect()) == sorted("A%d" % i for i in range(4, 11))


def test_properties_revenue_totals_agree(spark):
    """Per day: Σ daily_revenue = daily_orders.revenue = Σ by channel (users unique)."""
    from daymark.sources import tables as TB
    from tests.conftest import SF_SMALL

    tables = build_metric_tables(
        TB.orders_table(spark, SF_SMALL), TB.events_table(spark, SF_SMALL),
        TB.users_table(spark, SF_SMALL),
    )
    per_day = {r[0]: r[1] for r in tables["daily_orders"].df.select("order_date", "revenue").collect()}
    from pyspark.sql import functions as F

    for name in ("daily_revenue", "daily_revenue_by_channel"):
        col = "amount" if name == "daily_revenue" else "revenue"
        sums = tables[name].df.groupBy("order_date").agg(F.sum(col).alias("s")).collect()
        assert len(sums) == len(per_day)
        for r in sums:
            assert abs(r["s"] - per_day[r["order_date"]]) < 1e-6


def test_shuffle_path_equals_broadcast_path_with_hot_user(spark):
    """One user holds a third of the orders; both join strategies agree."""
    from pyspark.sql import functions as F

    from daymark.operators import quality as DQ

    base = spark.range(0, 3000)
    orders = base.select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id") % 97).alias("user_id"),
        (F.col("id") % 50 + 0.25).alias("amount"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 5 as int))").alias("order_ts"),
    )
    events = orders.select(F.col("order_id").cast("long").alias("event_id"), "user_id",
                           F.lit("view").alias("event_type"), F.col("order_ts").alias("ts"))
    users = spark.range(0, 100).select(
        F.col("id").alias("user_id"), F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("channel")
    )
    for fn, args in [
        (M.daily_revenue_by_channel, (orders, users)),
        (M.daily_active_users_by_channel, (events, users)),
    ]:
        a = fn(*args, broadcast_users=True)
        b = fn(*args, broadcast_users=False)
        a.collect(), b.collect()
        assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in b._jdf.queryExecution().executedPlan().toString()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    rule = DQ.Rule("orders", "user_id", "unique")
    x = DQ.violations(orders, rule, broadcast_keys=True)
    y = DQ.violations(orders, rule, broadcast_keys=False)
    assert x.count() == y.count() == 3000


def test_daily_orders_from_work_tables_matches(make_orders):
    o = make_orders([
        ("A1", 1, 5.0, ts("2024-01-01 10:00:00")),
        ("A1", 1, 7.0, ts("2024-01-01 11:00:00")),
        ("A2", None, 3.0, ts("2024-01-01 12:00:00")),
        (None, 2, 1.0, ts("2024-01-02 12:00:00")),
        ("A4", 2, 2.0, None),
    ])
    direct = rows(M.daily_orders(o), "order_date", "orders", "buyers", "revenue")
    derived = rows(
        M.daily_orders_from(M.distinct_orders_by_day(o), M.revenue_by_day_user(o)),
        "order_date", "orders", "buyers", "revenue",
    )
    assert direct == derived and len(direct) == 3


def test_a_dimension_of_wide_rows_is_not_broadcast(spark):
    from daymark.operators.joins import fits_broadcast

    dim = spark.createDataFrame([(i, "x" * 1000) for i in range(50)] + [(None, None)], "user_id long, channel string")
    assert fits_broadcast(dim) and not fits_broadcast(dim, max_bytes=50_000) and not fits_broadcast(dim, max_rows=50)
    assert fits_broadcast(dim.where("user_id < 0"), max_rows=0, max_bytes=0)
