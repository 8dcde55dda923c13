"""Session construction and the shared scratch folder.

The session is configured once, at build time; library functions never
mutate a live session.  Scratch output (lineage cuts, round trips) goes to
the shared folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Defaults for a batch job.  ANSI stays on (Spark 4 default): the library
# uses try_* functions where input may be junk.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

_LOCAL_FALLBACK: dict[str, str] = {}


def build_session(
    app_name: str = "daymark",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session with the job defaults plus ``conf`` overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    merged.update({k: str(v) for k, v in (conf or {}).items()})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (tests) gets a private
    folder; on a cluster an unset value is an error, because a machine-local
    folder would not be visible to the executors.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _LOCAL_FALLBACK:
        return _LOCAL_FALLBACK[app]
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for the cluster"
        )
    root = tempfile.mkdtemp(prefix="daymark-ckpt-")
    _LOCAL_FALLBACK[app] = root
    return root


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint root (never reused)."""
    leaf = "-".join(p for p in parts if p) or "scratch"
    return f"{checkpoint_root(spark)}/daymark/{leaf}-{uuid.uuid4().hex[:12]}"


__all__ = [
    "DEFAULT_CONF",
    "build_session",
    "checkpoint_root",
    "shared_dir",
]
