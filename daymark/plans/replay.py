"""Quarantined lines read again under a repair.

Bronze keeps lines that did not parse with their file and ingest.  A replay takes the
files that have such lines, applies a repair to the lines' text and parses them
again; together with the rows that parsed the first time they become the files' next
version.  Raw files are not read.  Lines that still do not parse stay in quarantine,
those that do have left it, and a file that is ingested again later replaces all of it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import schemas as S
from daymark.plans import bronze as B
from daymark.sources.csv import typed_orders
from daymark.sources.files import join_uri
from daymark.sources.ndjson import typed_events


@dataclass(frozen=True)
class Replay:
    kind: str
    ingest_id: str | None    # None: no line was in quarantine
    repaired: int
    corrupt: int             # lines that still do not parse
    days: tuple[dt.date, ...] = ()


def parse_lines(lines: DataFrame, kind: str, text: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The fields of each line next to its other columns; a line that does not parse keeps its
    text in ``_corrupt_record``.  CSV lines have the declared columns in the order of
    ``columns`` (by default as declared); columns that are not declared are left aside."""
    declared = S.ORDERS_RAW if kind == "orders" else S.EVENTS_RAW
    names = list(columns or declared.fieldNames())
    fields = [declared[n] if n in declared.fieldNames() else T.StructField(n, T.StringType()) for n in names]
    schema = T.StructType([*fields, T.StructField(S.CORRUPT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN}
    if kind == "orders":
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parsed = F.from_csv(F.col(text), ddl, options)
    else:
        parsed = F.from_json(F.col(text), schema, options)
    others = [c for c in lines.columns if c not in schema.fieldNames() and c != text]
    rows = lines.withColumn("__row", parsed).select(*others, *[F.col(f"__row.{n}").alias(n) for n in [*declared.fieldNames(), S.CORRUPT_COLUMN]])
    return typed_orders(rows) if kind == "orders" else typed_events(rows)


def replay_quarantine(
    spark: SparkSession, bronze_root: str, kind: str, repair: Callable[[Column], Column], *, columns: Sequence[str] | None = None
) -> Replay:
    """Give every raw file with quarantined lines a next version with the lines that parse after
    ``repair``.  Only the bronze rows of those files are read."""
    files = B.bronze_files(spark, bronze_root, kind).where("current AND corrupt > 0")
    # One number: the lines in quarantine.
    before = files.agg(F.coalesce(F.sum("corrupt"), F.lit(0))).first()[0]
    if not before:
        return Replay(kind, None, 0, 0)
    rows = B.read_versions(spark, bronze_root, kind, files, corrupt=True)
    own = [f.name for f in B.DATA_SCHEMAS[kind].fields if f.name != "ingest_id"]
    bad = F.col(S.CORRUPT_COLUMN).isNotNull()
    lines = rows.where(bad).select("source_file", "file_date", repair(F.col(S.CORRUPT_COLUMN)).alias("__text"), F.col(S.CORRUPT_COLUMN).alias("__line"))
    again = parse_lines(lines, kind, "__text", columns)
    # A line that still fails keeps the text it came with.
    again = again.withColumn(S.CORRUPT_COLUMN, F.when(F.col(S.CORRUPT_COLUMN).isNotNull(), F.col("__line")))
    done = B.write_ingest(rows.where(~bad).select(*own).unionByName(again.select(*own)), join_uri(bronze_root, kind), kind)
    return Replay(kind, done.ingest_id, before - done.corrupt, done.corrupt, done.days)


__all__ = ["Replay", "parse_lines", "replay_quarantine"]
