"""Which raw files are new or changed since a listing that was kept.

The listing has one row per file (path below the raw root, bytes, modification
time).  It is made by Spark's own parallel file listing, without reading the
files, and compared as a table; only the paths that changed come to the driver.
A file that has gone from the raw folder is not a change: raw folders are
emptied by retention rules, what the file brought stays.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import schemas as S
from daymark.sources.csv import concat_frames, read_csv
from daymark.sources.files import relative_name

LISTING = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("modified", T.TimestampType()),
])
#: Bytes of a file that are searched for its header line.
HEADER_BYTES = 1 << 16


def list_files(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """Files below ``root`` (at any depth) whose base name matches; no folder yet reads as no files."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name_glob).load(root)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], LISTING)
    return found.select(relative_name(root).alias("source_file"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def changed_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``listed`` without an equal (source_file, bytes, modified) in ``known``."""
    same = ["source_file", "bytes", "modified"]
    return listed.join(known.select(*same), same, "left_anti").select(*LISTING.fieldNames())


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in a CSV file's first line, found in its first bytes; () for an empty file."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        bounded = spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEADER_BYTES)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(bounded, "UTF-8")
    finally:
        stream.close()
    if not text.strip():
        return ()
    return tuple(next(csv.reader([text.removeprefix("﻿").splitlines()[0]])))


def layouts(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header: one small read per file, side by side."""
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda p: header_of(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(zip(paths, headers)):
        groups.setdefault(header, []).append(path)
    return groups


def read_csv_layouts(spark: SparkSession, paths: Sequence[str], schema: T.StructType, decorate=None) -> DataFrame:
    """CSV files whose headers differ, in one frame: the files of each layout are one scan,
    read by that layout's own header.

    Columns that ``schema`` does not declare are left out; a declared one that a
    header lacks is an error, as is no column at all known.  Lines that do not parse keep
    their text in ``_corrupt_record``.  ``decorate`` is applied to each scan (provenance).
    """
    keep = [*schema.fieldNames(), S.CORRUPT_COLUMN]
    frames = []
    for header, files in sorted(layouts(spark, paths).items()):
        if not header:
            continue
        df = read_csv(spark, files, schema, by_header=True, keep_corrupt=True)
        extra = [c for c in df.columns if c not in keep]
        df = df if decorate is None else decorate(df)
        frames.append(df.drop(*extra))
    if not frames:
        empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(S.CORRUPT_COLUMN, T.StringType())]))
        return empty if decorate is None else decorate(empty)
    return concat_frames(frames)


__all__ = ["HEADER_BYTES", "LISTING", "changed_files", "header_of", "layouts", "list_files", "read_csv_layouts"]
