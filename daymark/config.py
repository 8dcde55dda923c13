"""Job configuration: YAML file + environment overrides + Spark settings.

Layout (all keys optional)::

    paths:   {raw, bronze, silver, users, publish}
    outputs: {<table>: <path>}          # per-table silver target override
    pipeline: {days_back: 1, late_days: null, silver_format: parquet}
    quality_rules: {<table>: [{name, column, check, severity}, ...]}   # severity: error (stops the run) or warn
    spark_conf: {<key>: <value>}        # applied when the session is built

Environment: ``RUN_DATE``, ``DAYS_BACK``, ``DAYMARK_PATH_<NAME>`` for a path
and ``DAYMARK_OUTPUT_<TABLE>`` for a per-table target.
"""

from __future__ import annotations

import copy
import os
from collections.abc import Mapping
from typing import Any

from daymark.functions.temporal import parse_run_date
from daymark.operators.quality import DEFAULT_RULES, Rule, rules_from_config

DEFAULTS: dict[str, Any] = {
    "paths": {},
    "outputs": {},
    "pipeline": {"days_back": 1, "late_days": None, "silver_format": "parquet"},
    "quality_rules": None,
    "spark_conf": {},
}


def _merge(base: dict, over: Mapping) -> dict:
    out = copy.deepcopy(base)
    for k, v in over.items():
        if isinstance(v, Mapping) and isinstance(out.get(k), dict):
            out[k] = _merge(out[k], v)
        else:
            out[k] = copy.deepcopy(v)
    return out


def load_config(
    source: str | Mapping[str, Any] | None = None,
    env: Mapping[str, str] | None = None,
) -> dict[str, Any]:
    """Merge defaults, a YAML file (or mapping) and environment overrides."""
    env = os.environ if env is None else env
    cfg = copy.deepcopy(DEFAULTS)
    if isinstance(source, Mapping):
        cfg = _merge(cfg, source)
    elif source:
        import yaml

        with open(source, encoding="utf-8") as fh:
            cfg = _merge(cfg, yaml.safe_load(fh) or {})
    for key, value in env.items():
        if key.startswith("DAYMARK_PATH_"):
            cfg["paths"][key[len("DAYMARK_PATH_"):].lower()] = value
        elif key.startswith("DAYMARK_OUTPUT_"):
            cfg["outputs"][key[len("DAYMARK_OUTPUT_"):].lower()] = value
    if env.get("RUN_DATE"):
        cfg["run_date"] = parse_run_date(env["RUN_DATE"])
    elif cfg.get("run_date"):
        cfg["run_date"] = parse_run_date(cfg["run_date"])
    if env.get("DAYS_BACK"):
        cfg["pipeline"]["days_back"] = int(env["DAYS_BACK"])
    return cfg


def quality_rules(cfg: Mapping[str, Any]) -> list[Rule]:
    section = cfg.get("quality_rules")
    return rules_from_config(section) if section else list(DEFAULT_RULES)


def spark_conf(cfg: Mapping[str, Any]) -> dict[str, str]:
    return {str(k): str(v) for k, v in (cfg.get("spark_conf") or {}).items()}
