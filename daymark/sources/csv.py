"""CSV scans with declared schemas.

``enforceSchema=false`` makes Spark check every file's header against the
schema, so a file whose columns are reordered fails instead of being read
by position into the wrong columns.  No ``inferSchema`` pass is made.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daymark import schemas as S
from daymark.functions.temporal import parse_timestamp
from daymark.sources.files import as_paths, read_or_empty


def header_schema(spark: SparkSession, file: str, schema: T.StructType) -> T.StructType:
    """The columns of one file's header line, typed by ``schema``.

    Columns ``schema`` does not know are text; one that it declares and the
    header lacks is an error.  A file without a header line has ``schema``.
    """
    first = spark.read.text(file).first()
    if first is None:
        return schema
    names = next(csv.reader([first[0].removeprefix("\ufeff")]))
    missing = [f for f in schema.fieldNames() if f not in names]
    if missing:
        raise ValueError(f"{file}: the header lacks {', '.join(missing)}")
    return T.StructType([schema[n] if n in schema.fieldNames() else T.StructField(n, T.StringType(), True) for n in names])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    header: bool = True,
    check_header: bool = True,
    allow_empty: bool = False,
    recursive: bool = False,
    name_glob: str | None = None,
    by_header: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """One scan over many files; ``name_glob`` matches base names (any depth
    with ``recursive``), like listing a prefix and filtering names.

    ``by_header`` takes the columns from the first file's header (reordered
    columns are read by name, extra ones as text), and any file with another header still fails.  With
    ``keep_corrupt`` a line with a field that does not parse, or too few or too
    many fields, keeps its text in ``_corrupt_record``.
    """
    corrupt = [T.StructField(S.CORRUPT_COLUMN, T.StringType(), True)] if keep_corrupt else []
    full = T.StructType([*schema.fields, *corrupt])

    def reader(columns: T.StructType):
        out = (
            spark.read.schema(T.StructType([*columns.fields, *corrupt]))
            .option("header", header)
            .option("enforceSchema", not check_header)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", S.CORRUPT_COLUMN)
            # A line is judged by all its fields, whichever columns are used later.
            .option("columnPruning", not keep_corrupt)
        )
        if recursive:
            out = out.option("recursiveFileLookup", True)
        if name_glob:
            out = out.option("pathGlobFilter", name_glob)
        return out

    def read() -> DataFrame:
        df = reader(schema).csv(as_paths(paths))
        if by_header and header and (files := df.inputFiles()):
            columns = header_schema(spark, sorted(files)[0], schema)
            if columns != schema:
                df = reader(columns).csv(as_paths(paths))
        return df

    return read_or_empty(spark, read, full, allow_empty)


def typed_orders(raw: DataFrame) -> DataFrame:
    """Raw orders → bronze types (junk timestamps become NULL)."""
    out = raw.withColumn("order_ts", parse_timestamp("order_ts", raw.schema["order_ts"].dataType))
    return out


def read_orders_csv(
    spark: SparkSession, paths: str | Sequence[str], allow_empty: bool = False, **kw
) -> DataFrame:
    return typed_orders(read_csv(spark, paths, S.ORDERS_RAW, allow_empty=allow_empty, **kw))


def read_users_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = S.USERS_RAW,
    allow_empty: bool = False,
    **kw,
) -> DataFrame:
    return read_csv(spark, paths, schema, allow_empty=allow_empty, **kw)


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns missing from a frame become NULL."""
    if not frames:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
