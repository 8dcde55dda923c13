"""Raw-file resolution, URI handling, provenance and the missing-input policy.

Paths stay strings end to end, so the same code reads local folders, HDFS
or object stores through Hadoop file systems.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.temporal import parse_run_date

_SCHEME_ALIASES = {"s3://": "s3a://", "s3n://": "s3a://"}
# A raw file carries its date either in its name,
# ``<kind>_<yyyy-MM-dd>.<ext>``, or in a Hive-style parent folder ``<col>=<yyyy-MM-dd>``.
FILE_DATE_PATTERN = r"_(\d{4}-\d{2}-\d{2})\.[^./]+$"
DIR_DATE_PATTERN = r"=(\d{4}-\d{2}-\d{2})/[^/]+$"


def has_scheme(path: str) -> bool:
    head = path.split("/", 1)[0]
    return head.endswith(":") and len(head) > 2


def normalise_uri(path: str, mkdir: bool = False) -> str:
    """``s3://`` → ``s3a://``; a local path → absolute (optionally created)."""
    text = str(path)
    for old, new in _SCHEME_ALIASES.items():
        if text.startswith(old):
            return new + text[len(old):]
    if has_scheme(text):
        return text
    absolute = os.path.abspath(text)
    if mkdir:
        os.makedirs(absolute, exist_ok=True)
    return absolute


def join_uri(base: str, *parts: str) -> str:
    """String join that works for URIs and local paths alike."""
    out = str(base).rstrip("/")
    for p in parts:
        out = f"{out}/{str(p).strip('/')}"
    return out


def raw_pattern(kind: str, run_date: str | dt.date | None = None, ext: str = "csv") -> str:
    """``orders_2024-01-01.csv`` for a run date, ``orders_*.csv`` otherwise."""
    day = parse_run_date(run_date)
    return f"{kind}_{day.isoformat() if day else '*'}.{ext}"


def raw_window_pattern(
    kind: str, first: dt.date, last: dt.date, ext: str = "csv"
) -> str:
    """``orders_{2024-01-09,...,2024-01-15}.csv``: the raw files of a date window."""
    if last < first:
        raise ValueError("empty window")
    days = [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    body = days[0] if len(days) == 1 else "{" + ",".join(days) + "}"
    return f"{kind}_{body}.{ext}"


def relative_name(root: str | None) -> Column:
    """A scanned file's path below ``root``; its whole path if it lies elsewhere.

    Two files of the same base name in different folders stay apart.
    """
    path = F.col("_metadata.file_path")
    if root is None:
        return F.col("_metadata.file_name")
    below = re.sub(r"^[a-z0-9]+:/*", "/", normalise_uri(root)).rstrip("/") + "/"
    at = F.instr(path, below)
    return F.when(at > 0, F.substring(path, at + len(below), F.length(path))).otherwise(path)


def with_provenance(df: DataFrame, root: str | None = None) -> DataFrame:
    """Add ``source_file`` and ``file_date`` (from name or folder).

    ``source_file`` is the path below ``root``, or the base name without a root.
    Must be applied directly on a file scan, where ``_metadata`` exists; an
    empty placeholder frame gets NULL provenance.
    """
    try:
        df.select("_metadata.file_name")
    except AnalysisException:
        return df.withColumns({
            "source_file": F.lit(None).cast("string"),
            "file_date": F.lit(None).cast("date"),
        })
    name = F.col("_metadata.file_name")
    from_name = F.regexp_extract(name, FILE_DATE_PATTERN, 1)
    from_dir = F.regexp_extract(F.col("_metadata.file_path"), DIR_DATE_PATTERN, 1)
    date_text = F.when(from_name != "", from_name).when(from_dir != "", from_dir)
    return df.withColumns({
        "source_file": relative_name(root),
        "file_date": date_text.cast("date"),
    })


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    schema: T.StructType,
    allow_empty: bool = False,
) -> DataFrame:
    """Run ``read``; no input raises unless ``allow_empty`` (then empty).

    No input is a missing path, or a folder with no file that matches.
    """
    try:
        df = read()
    except AnalysisException as exc:
        if allow_empty and "PATH_NOT_FOUND" in str(exc):
            return empty_frame(spark, schema)
        raise
    if df.inputFiles():
        return df
    if allow_empty:
        return empty_frame(spark, schema)
    raise FileNotFoundError("no input file matches")


def as_paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
