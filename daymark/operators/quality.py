"""Declarative data-quality rules evaluated on executors.

Checks: ``not_null(col)``, ``gt_zero(col)`` (``col <= 0`` and NaN fail, NULL passes)
and ``unique(col)`` (every member of a duplicated key fails, NULL keys are
one group).  Results are DataFrames: the violating rows, a quarantine table
(table, rule, row as JSON) and a per-rule summary.  ``gate`` is the only
action: it collects the summary — one row per rule — and raises when a rule
failed, before anything is published.  Rows that break a rule of severity
``warn`` are counted and quarantined like others, but do not stop the gate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daymark.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, prepare_dimension

CHECKS = ("not_null", "gt_zero", "unique")
SEVERITIES = ("error", "warn")


class DataQualityError(RuntimeError):
    """Raised by the gate when at least one rule failed."""

    def __init__(self, failures: Sequence[tuple[str, str, int]]):
        self.failures = list(failures)
        text = ", ".join(f"{t} :: {r} ({n} rows)" for t, r, n in self.failures)
        super().__init__(f"data quality failed: {text}")


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    check: str
    name: str | None = None
    severity: str = "error"

    def __post_init__(self) -> None:
        if self.check not in CHECKS:
            raise ValueError(f"unknown check {self.check!r}; expected one of {CHECKS}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"unknown severity {self.severity!r}; expected one of {SEVERITIES}")

    @property
    def label(self) -> str:
        return f"{self.check}({self.column})"


# The rule set the daily job declares (table, name, column, check).
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("orders", "order_id", "not_null", "non_null_order_id"),
    Rule("orders", "amount", "gt_zero", "positive_amount"),
    Rule("users", "user_id", "unique", "unique_user_id"),
)


def rules_from_config(section: Mapping[str, Iterable[Mapping[str, str]]]) -> list[Rule]:
    """``{table: [{name, column, check, severity}, ...]}`` → rules (YAML ``quality_rules``)."""
    rules = []
    for table, items in section.items():
        for item in items:
            rules.append(Rule(table, item["column"], item["check"], item.get("name"), item.get("severity", "error")))
    return rules


def _failing(col: Column, check: str) -> Column:
    if check == "not_null":
        return col.isNull()
    if check == "gt_zero":
        return (col <= F.lit(0)) | F.isnan(col.cast("double"))
    raise ValueError(check)


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys seen more than once (NULL is one key); partial counts map-side."""
    return (
        df.groupBy(F.col(column).alias("_dup_key"))
        .agg(F.count(F.lit(1)).alias("_dup_n"))
        .where(F.col("_dup_n") > 1)
        .select("_dup_key")
    )


def violations(
    df: DataFrame,
    rule: Rule,
    broadcast_keys: bool | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``df`` that break ``rule`` (same columns as ``df``).

    For ``unique`` the duplicated keys are counted first (one job over the
    key column): a small set is broadcast, a large one is joined by a
    shuffle sort-merge join whose hot keys AQE splits.  No window over the
    key, whose hot partition would be a single task.
    """
    col = F.col(rule.column)
    if rule.check in ("not_null", "gt_zero"):
        return df.where(_failing(col, rule.check))
    dups = prepare_dimension(
        duplicate_keys(df, rule.column), broadcast_keys, max_broadcast_rows
    )
    return df.join(dups, df[rule.column].eqNullSafe(dups["_dup_key"]), "left_semi")


def quarantine(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """One row per (violating row, rule): table_name, rule, row_json."""
    parts = []
    for rule in rules:
        df = tables[rule.table]
        parts.append(
            violations(df, rule).select(
                F.lit(rule.table).alias("table_name"),
                F.lit(rule.label).alias("rule"),
                F.to_json(
                    F.struct(*[F.col(c) for c in df.columns]),
                    {"ignoreNullFields": "false"},
                ).alias("row_json"),
            )
        )
    if not parts:
        raise ValueError("no rules")
    return reduce(DataFrame.unionByName, parts)


def _row_rules_summary(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """not_null / gt_zero rules of one table in a single aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("rows_checked")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(_failing(F.col(r.column), r.check)).alias(f"v{i}"))
    wide = df.agg(*aggs)
    stacked = wide.select(
        "rows_checked",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(r.label).alias("rule"), F.col(f"v{i}").alias("violations"))
                    for i, r in enumerate(rules)
                ]
            )
        ).alias("r"),
    )
    return stacked.select(
        F.lit(table).alias("table_name"),
        F.col("r.rule").alias("rule"),
        "rows_checked",
        F.col("r.violations").alias("violations"),
    )


def _unique_summary(table: str, df: DataFrame, rule: Rule) -> DataFrame:
    counts = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows_checked"),
        F.coalesce(
            F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0).cast("long")
        ).alias("violations"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(rule.label).alias("rule"),
        "rows_checked",
        "violations",
    )


def rule_summary(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """table_name, rule, rows_checked, violations, ok — one row per rule."""
    rules = list(rules)
    parts = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if r.table not in tables:
            raise KeyError(f"rule {r.label} names unknown table {r.table!r}")
        if r.check == "unique":
            parts.append(_unique_summary(r.table, tables[r.table], r))
        else:
            by_table.setdefault(r.table, []).append(r)
    for table, rs in by_table.items():
        parts.append(_row_rules_summary(table, tables[table], rs))
    if not parts:
        raise ValueError("no rules")
    out = reduce(DataFrame.unionByName, parts)
    return out.select(
        "table_name",
        "rule",
        F.col("rows_checked").cast("long").alias("rows_checked"),
        F.col("violations").cast("long").alias("violations"),
        (F.col("violations") == 0).alias("ok"),
    )


def run_summary(summary: DataFrame) -> DataFrame:
    """One row for the run: rules_run, failed_rules, violations, passed."""
    return summary.agg(
        F.count(F.lit(1)).alias("rules_run"),
        F.count_if(~F.col("ok")).alias("failed_rules"),
        F.coalesce(F.sum("violations"), F.lit(0).cast("long")).alias("violations"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("passed"),
    )


def gate(summary: DataFrame, rules: Iterable[Rule] = ()) -> list[tuple[str, str, int]]:
    """Collect the (per-rule, bounded) summary; raise if any rule failed that ``rules`` does not name as a warning."""
    rows = [
        (r["table_name"], r["rule"], int(r["rows_checked"]), int(r["violations"]))
        for r in summary.collect()
    ]
    return gate_results(rows, rules)


def gate_results(results: Sequence[tuple[str, str, int, int]], rules: Iterable[Rule] = ()) -> list[tuple[str, str, int]]:
    """(table, rule, rows_checked, violations) records → raise if any failed that ``rules`` does not name as a warning."""
    rules = list(rules)
    named = {s: {(r.table, r.label) for r in rules if r.severity == s} for s in SEVERITIES}
    warned = named["warn"] - named["error"]
    failures = [(t, r, v) for t, r, _, v in results if v and (t, r) not in warned]
    if failures:
        raise DataQualityError(failures)
    return [(t, r, n) for t, r, n, _ in results]


def _json_row(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


def observed_quarantine(
    tables: Mapping[str, DataFrame], rules: Iterable[Rule]
) -> tuple[DataFrame, Callable[[], list[tuple[str, str, int, int]]]]:
    """Quarantine rows plus the per-rule summary from the same single pass.

    Row rules of one table share one scan: rows failing any rule are kept
    and exploded into one record per failing rule, while an ``Observation``
    on the scan counts the rows checked and each rule's violations.  A unique
    rule's counts come from one small aggregate over its key (collected as one
    row), which also decides the join side; its rows are added only when there
    are duplicates.  Write (or otherwise act on) the returned frame once, then
    call the returned function for (table, rule, rows_checked, violations).
    """
    rules = list(rules)
    parts: list[DataFrame] = []
    readers: list[Callable[[], list[tuple[str, str, int, int]]]] = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if r.check == "unique":
            # Counts come from one aggregate over the key (an Observation
            # inside the semi-join would vanish when AQE prunes a join with
            # an empty duplicate set); the same numbers pick the join side.
            df = tables[r.table]
            counts = df.groupBy(F.col(r.column).alias("_dup_key")).agg(
                F.count(F.lit(1)).alias("_dup_n")
            )
            dup = F.col("_dup_n") > 1
            stats = counts.agg(
                F.coalesce(F.sum("_dup_n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(dup, F.col("_dup_n"))), F.lit(0)).alias("bad"),
                F.count_if(dup).alias("keys"),
            ).collect()[0]
            readers.append(
                lambda r=r, st=stats: [(r.table, r.label, int(st["rows"]), int(st["bad"]))]
            )
            if stats["bad"]:
                dups = prepare_dimension(
                    counts.where(dup).select("_dup_key"),
                    broadcast=stats["keys"] <= DEFAULT_MAX_BROADCAST_ROWS,
                )
                bad = df.join(dups, df[r.column].eqNullSafe(dups["_dup_key"]), "left_semi")
                parts.append(bad.select(
                    F.lit(r.table).alias("table_name"), F.lit(r.label).alias("rule"),
                    _json_row(df).alias("row_json"),
                ))
        else:
            by_table.setdefault(r.table, []).append(r)
    for table, rs in by_table.items():
        df = tables[table]
        fails = [_failing(F.col(r.column), r.check) for r in rs]
        obs = Observation(f"dq_{uuid.uuid4().hex[:10]}")
        observed = df.observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(f).alias(f"v{i}") for i, f in enumerate(fails)],
        )
        bad = observed.where(reduce(lambda a, b: a | b, fails))
        labels = F.array_compact(F.array(*[
            F.when(f, F.lit(r.label)) for f, r in zip(fails, rs)
        ]))
        parts.append(bad.select(
            F.lit(table).alias("table_name"), F.explode(labels).alias("rule"),
            _json_row(df).alias("row_json"),
        ))

        def read(table=table, rs=rs, obs=obs, df=df, fails=fails):
            try:
                got = obs.get
            except Exception:  # noqa: BLE001 - branch pruned (empty input): count directly
                got = df.agg(
                    F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(f).alias(f"v{i}") for i, f in enumerate(fails)],
                ).collect()[0].asDict()
            return [(table, r.label, int(got["rows"]), int(got[f"v{i}"])) for i, r in enumerate(rs)]

        readers.append(read)
    if not readers:
        raise ValueError("no rules")
    if parts:
        frame = reduce(DataFrame.unionByName, parts)
    else:
        first = next(iter(tables.values()))
        frame = first.sparkSession.createDataFrame([], "table_name string, rule string, row_json string")

    def results() -> list[tuple[str, str, int, int]]:
        return [rec for read in readers for rec in read()]

    return frame, results
