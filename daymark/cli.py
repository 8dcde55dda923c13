"""Command-line entry point for schedulers.

``python -m daymark --config job.yaml [--run-date 2024-01-15] [--days-back 7]``

Builds the session from the config's ``spark_conf``, runs the daily job,
prints one JSON line per stage and returns 0, or 1 when the quality gate
(or a publish) failed — so a scheduler task fails on bad data.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from daymark.config import load_config, quality_rules, spark_conf
from daymark.functions.money import MONEY_SCALE
from daymark.operators.quality import DataQualityError
from daymark.plans.job import JobPaths, run_daily_job
from daymark.session import build_session
from daymark.sinks.warehouse import PublishError


def _paths(cfg: dict) -> JobPaths:
    p = cfg["paths"]
    missing = [k for k in ("bronze", "silver", "users") if not p.get(k)]
    if missing:
        raise SystemExit(f"config paths missing: {', '.join(missing)}")
    return JobPaths(
        bronze=p["bronze"], silver=p["silver"], users=p["users"], raw=p.get("raw"),
        publish=p.get("publish"), export=p.get("export"), outputs=dict(cfg.get("outputs") or {}),
        raw_orders=p.get("raw_orders"), raw_events=p.get("raw_events"),
        warehouse=p.get("warehouse"), database=p.get("database"),
    )


def main(argv: Sequence[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="daymark", description="daily metrics job")
    ap.add_argument("--config", help="YAML config file")
    ap.add_argument("--run-date", help="YYYY-MM-DD (overrides RUN_DATE)")
    ap.add_argument("--days-back", type=int, help="look-back window in days")
    ap.add_argument("--master", help="Spark master (default: from the environment)")
    ap.add_argument("--publish", action="store_true", help="publish after writing silver")
    args = ap.parse_args(argv)

    cfg = load_config(args.config)
    run_date = args.run_date or cfg.get("run_date")
    days_back = args.days_back or int(cfg["pipeline"].get("days_back") or 1)
    spark = build_session("daymark-daily", master=args.master, conf=spark_conf(cfg))
    try:
        result = run_daily_job(
            spark, _paths(cfg), run_date=run_date, days_back=days_back,
            rules=quality_rules(cfg), silver_format=cfg["pipeline"].get("silver_format", "parquet"),
            late_days=cfg["pipeline"].get("late_days"), do_publish=args.publish,
            max_parse_failures=int(cfg["pipeline"].get("max_parse_failures") or 0),
            scale=int(cfg["pipeline"].get("scale") or MONEY_SCALE),
        )
    except (DataQualityError, PublishError, FileNotFoundError) as exc:
        print(json.dumps({"event": "failed", "error": str(exc)}), flush=True)
        return 1
    for s in result.stages:
        print(json.dumps({
            "run_id": s.run_id, "stage": s.stage, "table": s.table_name,
            "run_date": s.run_date.isoformat() if s.run_date else None,
            "rows": s.rows, "seconds": s.seconds,
        }), flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
