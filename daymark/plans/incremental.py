"""The daily tables kept up to date by what changed.

A run lists the raw files, ingests those that are new or changed since the last
commit, and works on their *delta*: the rows that their new versions bring,
counted +1, and the rows that the versions counted so far brought, counted -1.
Per day there is a mergeable state

* ``state_orders``: (day, order id) and how many rows hold it,
* ``state_buyers``: (day, user) with rows, rows with an amount, and summed amount,
* ``state_active``: (day, user) and how many event rows hold it;

the delta is aggregated the same way and added to the state of the days it
touches; what comes to zero is gone.  The six tables of those days follow from
the state.  A corrected or late file costs its own rows and the state of its
days: no other raw file and no other bronze row is read.

Listing, states, key index and the six tables are one commit of a
``SnapshotStore``.  What counts as ingested is the committed listing, so a run
that failed at any place is as if it had not begun: the next one ingests its
files again and takes back exactly what the committed versions brought.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import schemas as S
from daymark.functions.money import MONEY_SCALE, minor_units
from daymark.functions.temporal import day_of
from daymark.operators import key_index as K
from daymark.operators import metrics as M
from daymark.operators import quality as DQ
from daymark.operators.joins import fits_broadcast
from daymark.plans import bronze as B
from daymark.plans.daily import LAYOUTS, PARTITION_COLUMNS, TIE_COLUMNS
from daymark.plans.job import STAGE_SCHEMA, JobPaths, StageRecord, read_users
from daymark.schemas import CORRUPT_COLUMN, OUTPUT_SCHEMAS
from daymark.sinks.files import write_flat
from daymark.sinks.snapshots import Partition, Snapshot, SnapshotStore, Transaction
from daymark.sinks.warehouse import publish_changes
from daymark.sources.files import join_uri
from daymark.sources.listing import LISTING, changed_files, list_files

KINDS = {"orders": "orders_*.csv", "events": "events_*.ndjson"}
STATES = {
    "state_orders": T.StructType([T.StructField("order_date", T.DateType()), T.StructField("order_id", T.StringType()), T.StructField("n", T.LongType())]),
    "state_buyers": T.StructType([
        T.StructField("order_date", T.DateType()), T.StructField("user_id", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("amounts", T.LongType()), T.StructField(M.MINOR_COLUMN, T.LongType()),
    ]),
    "state_active": T.StructType([T.StructField("event_date", T.DateType()), T.StructField("user_id", T.LongType()), T.StructField("n", T.LongType())]),
}
LISTED = T.StructType([T.StructField("kind", T.StringType()), *LISTING.fields, T.StructField("ingest_id", T.StringType()), T.StructField("file_date", T.DateType()), T.StructField("rows", T.LongType())])
#: The rule over keys of all ingests: (table, column).
ORDER_KEY = ("orders", "order_id")


@dataclass
class IncrementalResult:
    run_id: str
    snapshot: Snapshot
    changed: dict[str, int]                       # files ingested, by kind
    days: dict[str, tuple[dt.date | None, ...]]   # days restated, by kind
    quality: list[tuple[str, str, int]] = field(default_factory=list)
    stages: list[StageRecord] = field(default_factory=list)

    def stages_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(s.run_id, s.stage, s.table_name, s.run_date, s.rows, s.seconds) for s in self.stages]
        return spark.createDataFrame(rows, STAGE_SCHEMA)


def _days(delta: DataFrame, column: str) -> list[dt.date | None]:
    """The days of a delta: one row per day."""
    return [r[0] for r in delta.select(column).distinct().collect()]


def _merge(t: Transaction, table: str, delta: DataFrame, keys: list[str], sums: list[str], days: list[dt.date | None]) -> DataFrame:
    """Add the signed ``delta`` to the state of its days, write it, and return those days' state."""
    schema, store = STATES[table], t.store
    old = store.read(table, schema, days, t.base)
    both = old.unionByName(delta.select(*schema.fieldNames()))
    state = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).where("n <> 0").select(*schema.fieldNames())
    new = t.write(table, state, keys[0], values=days, tie_cols=keys[1:])
    return _written(store, table, schema, new)


def _written(store: SnapshotStore, table: str, schema: T.StructType, new: dict[str, Partition]) -> DataFrame:
    return store.read_folders(table, schema, [f for p in new.values() for f in p.folders])


def _users_digest(users: DataFrame) -> str:
    r = users.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("user_id", "channel")), F.lit(0)).alias("x"), F.coalesce(F.sum(F.xxhash64("user_id", "channel") % 1_000_003), F.lit(0)).alias("s")).first()
    return f"{r['n']}:{r['x']}:{r['s']}"


def run_incremental(
    spark: SparkSession,
    paths: JobPaths,
    rules: Sequence[DQ.Rule] = DQ.DEFAULT_RULES,
    max_parse_failures: int = 0,
    scale: int = MONEY_SCALE,
    globs: dict[str, str] | None = None,
    unique_orders: bool = False,
    do_publish: bool = False,
    replayed: dict[str, str] | None = None,
) -> IncrementalResult:
    """Ingest what is new or changed below the raw roots and bring the tables up to date.

    ``paths.silver`` is the root of the snapshot store.  ``replayed`` names the ingest of a
    replay of quarantined lines, by kind: its files count as changed, with the rows it gave them.  Row rules check the rows of the
    changed files, rules on users the whole users file.  With ``unique_orders`` an order id
    may occur in one row of all raw files together; rows that break this are found through
    the key index.  ``do_publish`` brings the store at ``paths.publish`` up to the new commit,
    copying only what differs.  A failed gate commits nothing.  If the users file differs from the last
    run's, the channel tables are restated for all days.
    """
    run_id, stages = uuid.uuid4().hex[:12], []
    store = SnapshotStore(spark, paths.silver)
    t = store.begin()
    base = t.base

    def record(stage: str, table: str, rows: int | None, t0: float) -> None:
        stages.append(StageRecord(run_id, stage, table, None, rows, round(time.time() - t0, 3)))

    work = join_uri(paths.bronze, "_work", f"run_id={run_id}")

    # 1. What changed, and its rows in bronze.
    fresh: dict[str, DataFrame] = {}
    stale: dict[str, DataFrame] = {}
    parse: list[DataFrame] = []
    changed: dict[str, int] = {}
    for kind, root in (("orders", paths.orders_source), ("events", paths.events_source)):
        if not root:
            continue
        t0 = time.time()
        known = store.read("listing", LISTED, [kind], base)
        listed = list_files(spark, root, (globs or KINDS)[kind])
        changed_files(listed, known).write.parquet(join_uri(work, f"changed_{kind}"))
        news = spark.read.schema(LISTING).parquet(join_uri(work, f"changed_{kind}"))
        # One path per changed file, to scan them.
        files = [r["path"] for r in news.select("path").collect()]
        changed[kind] = len(files)
        record("list", kind, len(files), t0)
        replay = (replayed or {}).get(kind)
        if not files and not replay:
            continue
        t0 = time.time()
        ingested = spark.read.schema(B.FILES_SCHEMA)
        versions, unparsed = [], bool(replay)
        if files:
            ingest = B.write_ingest(B.read_raw(spark, kind, root, files), join_uri(paths.bronze, kind), kind)
            record("ingest", kind, ingest.rows, t0)
            versions.append((news, ingest.ingest_id))
            unparsed |= ingest.corrupt > 0
        if replay:
            # Files of the replay that were not changed since.
            own = ingested.parquet(join_uri(paths.bronze, kind, "files")).where(F.col("ingest_id") == replay)
            kept = known.select(*LISTING.fieldNames()).join(own.select("source_file"), "source_file", "left_semi")
            versions.append((kept.join(news.select("source_file"), "source_file", "left_anti").select(*LISTING.fieldNames()), replay))
        # A file without a line has no bronze row, but is listed.
        dates = ingested.parquet(join_uri(paths.bronze, kind, "files")).select("source_file", "ingest_id", "file_date", F.col("rows") - F.col("corrupt"))
        dates = dates.toDF("source_file", "ingest_id", "file_date", "rows")
        parts = [v.withColumns({"kind": F.lit(kind), "ingest_id": F.lit(i)}) for v, i in versions]
        new = reduce(DataFrame.unionByName, parts).join(dates, ["source_file", "ingest_id"], "left")
        old = known.join(new.select("source_file"), "source_file", "left_semi")
        rest = known.join(new.select("source_file"), "source_file", "left_anti")
        t.write("listing", rest.unionByName(new.select(*LISTED.fieldNames())), "kind", values=[kind], layout="none")
        fresh[kind] = B.read_versions(spark, paths.bronze, kind, new)
        stale[kind] = B.read_versions(spark, paths.bronze, kind, old)
        if unparsed:
            parse.append(B.read_bronze_quarantine(spark, paths.bronze, kind, [i for _, i in versions]).select("table_name", "rule", "row_json"))

    source_users = read_users(spark, paths.users)
    source_users.write.parquet(join_uri(work, "users"))
    all_users = spark.read.schema(source_users.schema).parquet(join_uri(work, "users"))
    users = all_users.where(F.col(CORRUPT_COLUMN).isNull()).select("user_id", "channel")
    parse.append(all_users.where(F.col(CORRUPT_COLUMN).isNotNull()).select(F.lit("users").alias("table_name"), F.lit("parse").alias("rule"), F.col(CORRUPT_COLUMN).alias("row_json")))

    # 2. Quality of what changed.
    t0 = time.time()
    tables = {"users": users, **fresh}
    used = [r for r in rules if r.table in tables]
    results = list
    if used:
        frame, results = DQ.observed_quarantine(tables, used)
        parse.append(frame)
    breaches = None
    if unique_orders and "orders" in fresh:
        index = K.KeyIndex(store, *ORDER_KEY)
        rows = fresh["orders"].select("source_file", "ingest_id", "order_id")
        breaches = index.check(t, rows, store.read("listing", LISTED, ["orders"], t.snapshot()))
        index.add(t, rows)
        parse.append(breaches.violations(fresh["orders"], S.ORDERS.fieldNames()))
    quarantine = join_uri(paths.bronze, "_quality", f"run_id={run_id}")
    frame = parse[0]
    for more in parse[1:]:
        frame = frame.unionByName(more)
    q = write_flat(frame, quarantine, fmt="parquet")
    record("quality", "quarantine", q.rows, t0)
    kept = spark.read.schema("table_name string, rule string, row_json string").parquet(quarantine)
    counts = {(r["table_name"], r["rule"]): r["count"] for r in kept.groupBy("table_name", "rule").count().collect()}
    checked = results()
    unparsed = sum(n for (_, rule), n in counts.items() if rule == "parse")
    if unparsed > max_parse_failures:
        checked = [*checked, *((table, rule, n, n) for (table, rule), n in sorted(counts.items()) if rule == "parse")]
    if breaches is not None:
        checked = [*checked, ("orders", K.RULE, counts.get(("orders", K.RULE), 0), counts.get(("orders", K.RULE), 0))]
    quality = DQ.gate_results(checked, used)

    # 3. Deltas into the states, states into the tables.
    users_digest = _users_digest(users)
    new_users = users_digest != base.meta.get("users")
    small = fits_broadcast(users)
    days: dict[str, tuple[dt.date | None, ...]] = {}

    def signed(kind: str, row) -> DataFrame:
        return row(fresh[kind], 1).unionByName(row(stale[kind], -1))

    def put(name: str, df: DataFrame, values: Sequence[dt.date | None] | None) -> None:
        t0 = time.time()
        new = t.write(name, df.select(*OUTPUT_SCHEMAS[name].fieldNames()), PARTITION_COLUMNS[name], values=values, layout=LAYOUTS[name], tie_cols=TIE_COLUMNS.get(name, ()))
        record("transform", name, sum(p.rows for p in new.values()), t0)

    def state(name: str, values: Sequence[dt.date | None] | None = None) -> DataFrame:
        return store.read(name, STATES[name], values, t.snapshot())

    if "orders" in fresh:
        t0 = time.time()
        delta = join_uri(work, "delta_orders")
        day = day_of("order_ts").alias("order_date")
        rows = signed("orders", lambda df, sign: df.select(day, "order_id", "user_id", minor_units("amount", scale).alias("_m"), F.lit(sign).cast("long").alias("n")))
        # Per day, order and user, so that both states follow from one pass over the rows.
        has = F.when(F.col("_m").isNotNull(), F.col("n")).otherwise(0)
        grouped = rows.groupBy("order_date", "order_id", "user_id").agg(F.sum("n").alias("n"), F.sum(has).alias("amounts"), F.coalesce(F.sum(F.col("_m") * F.col("n")), F.lit(0)).alias(M.MINOR_COLUMN))
        grouped.where(f"n <> 0 OR amounts <> 0 OR {M.MINOR_COLUMN} <> 0").write.parquet(delta)
        rows = spark.read.parquet(delta)
        own = _days(rows, "order_date")
        days["orders"] = tuple(own)
        orders = rows.groupBy("order_date", "order_id").agg(F.sum("n").alias("n"))
        buyers = rows.groupBy("order_date", "user_id").agg(*[F.sum(c).alias(c) for c in ("n", "amounts", M.MINOR_COLUMN)])
        state_orders = _merge(t, "state_orders", orders, ["order_date", "order_id"], ["n"], own)
        _merge(t, "state_buyers", buyers, ["order_date", "user_id"], ["n", "amounts", M.MINOR_COLUMN], own)
        record("state", "orders", len(own), t0)
    if "events" in fresh:
        t0 = time.time()
        delta = join_uri(work, "delta_events")
        rows = signed("events", lambda df, sign: df.select(day_of("ts").alias("event_date"), "user_id", F.lit(sign).cast("long").alias("n")))
        rows.groupBy("event_date", "user_id").agg(F.sum("n").alias("n")).where("n <> 0").write.parquet(delta)
        rows = spark.read.parquet(delta)
        own = _days(rows, "event_date")
        days["events"] = tuple(own)
        _merge(t, "state_active", rows, ["event_date", "user_id"], ["n"], own)
        record("state", "events", len(own), t0)

    order_days, event_days = list(days.get("orders", ())), list(days.get("events", ()))
    minor = F.when(F.col("amounts") > 0, F.col(M.MINOR_COLUMN)).alias(M.MINOR_COLUMN)
    per_user = lambda values: state("state_buyers", values).select("order_date", "user_id", minor)
    pairs = lambda values: state("state_active", values).select("event_date", "user_id")
    if order_days:
        counts = state_orders.groupBy("order_date").agg(F.count("order_id").alias("orders"))
        put("daily_orders", M.daily_orders_from(counts, per_user(order_days), scale), order_days)
        put("daily_revenue", M.daily_revenue_from_minor(per_user(order_days), scale), order_days)
    if event_days:
        put("daily_active_users", M.daily_active_users_from_pairs(pairs(event_days)), event_days)
    channel_days = (None, None) if new_users else (order_days, event_days)
    if new_users or order_days:
        put("daily_revenue_by_channel", M.daily_revenue_by_channel(None, users, scale, broadcast_users=small, per_user_minor=per_user(channel_days[0])), channel_days[0])
    if new_users or event_days:
        put("daily_active_users_by_channel", M.daily_active_users_by_channel_from_pairs(pairs(channel_days[1]), users, small), channel_days[1])
    both = [*{*order_days, *event_days}]
    if both:
        daily = {n: store.read(n, OUTPUT_SCHEMAS[n], both, t.snapshot()) for n in ("daily_active_users", "daily_orders")}
        put("daily_conversion", M.conversion_from(daily["daily_active_users"], daily["daily_orders"].select("order_date", "buyers")), both)
    done = t.commit({"run_id": run_id, "users": users_digest})
    if do_publish and paths.publish:
        t0 = time.time()
        for p in publish_changes(store, SnapshotStore(spark, paths.publish), OUTPUT_SCHEMAS):
            record("publish", p.table_name, p.rows_written, t0)
    result = IncrementalResult(run_id, done, changed, days, quality, stages)
    write_flat(result.stages_frame(spark), join_uri(paths.bronze, "_job", "stage_metrics"), fmt="parquet", mode="append", count_rows=False)
    return result


def read_table(spark: SparkSession, paths: JobPaths, name: str, days: Sequence[dt.date | None] | None = None) -> DataFrame:
    """One of the six tables as last committed."""
    return SnapshotStore(spark, paths.silver).read(name, OUTPUT_SCHEMAS[name], days)


__all__ = ["IncrementalResult", "read_table", "run_incremental"]
