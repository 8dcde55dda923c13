"""Newline-delimited JSON scans.

Declared schema plus ``_corrupt_record``: a missing key is NULL, an extra
key is ignored, blank lines are skipped, a nested value in a STRING field
is kept as JSON text, and an unparseable line keeps its text in
``_corrupt_record`` for quarantine instead of ending the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import schemas as S
from daymark.functions.temporal import parse_timestamp
from daymark.sources.files import as_paths, read_or_empty


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if S.CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(S.CORRUPT_COLUMN, T.StringType(), True)])


def read_ndjson(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = S.EVENTS_RAW,
    allow_empty: bool = False,
    recursive: bool = False,
    name_glob: str | None = None,
) -> DataFrame:
    full = with_corrupt_column(schema)

    def read() -> DataFrame:
        reader = (
            spark.read.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", S.CORRUPT_COLUMN)
        )
        if recursive:
            reader = reader.option("recursiveFileLookup", True)
        if name_glob:
            reader = reader.option("pathGlobFilter", name_glob)
        return reader.json(as_paths(paths))

    return read_or_empty(spark, read, full, allow_empty)


def typed_events(raw: DataFrame) -> DataFrame:
    """Raw events → bronze types; keeps ``_corrupt_record`` if present."""
    return raw.withColumn("ts", parse_timestamp("ts", raw.schema["ts"].dataType))


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the corrupt column, quarantine rows).

    Quarantine rows carry the raw line as ``row_json`` next to whatever
    fields did parse (Spark also refuses a raw scan that reads nothing but
    the corrupt-record column).
    """
    bad = F.col(S.CORRUPT_COLUMN).isNotNull()
    parsed = [c for c in raw.columns if c != S.CORRUPT_COLUMN]
    clean = raw.where(~bad).drop(S.CORRUPT_COLUMN)
    quarantined = raw.where(bad).select(
        F.lit("events").alias("table_name"),
        F.lit("parse").alias("rule"),
        F.col(S.CORRUPT_COLUMN).alias("row_json"),
        *parsed,
    )
    return clean, quarantined
