"""Several tables, one commit.

A store is a folder with ``data`` (files of every commit, never changed once
written) and ``commits`` (one small JSON file per commit, numbered).  A commit
names, for every table and partition value, the folders that hold its rows; the
highest number is the current state.  A writer puts its files into folders of
its own and becomes visible in all tables at once when its commit file is
created, or not at all.  A job that dies leaves the last commit as it was.

Commit files list partitions, not rows: days times tables.  Creating one fails
if the number is taken, so of two writers that began from the same commit the
second gets ``CommitConflict`` and overwrites nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.sinks.files import NULL_PARTITION, layout_for_write
from daymark.sources.files import join_uri


class CommitConflict(RuntimeError):
    """Another writer committed since this one began."""


def partition_text(value: Any) -> str:
    """A partition value as its folder spells it."""
    return NULL_PARTITION if value is None else str(value)


@dataclass(frozen=True)
class Partition:
    """Rows of one partition value: folders below ``data``, their number, and a
    digest of the rows that does not depend on their order or files."""

    folders: tuple[str, ...]
    rows: int
    digest: str


@dataclass(frozen=True)
class Snapshot:
    version: int
    tables: dict[str, dict[str, Partition]]
    columns: dict[str, str]
    meta: dict[str, Any] = field(default_factory=dict)

    def partitions(self, table: str) -> dict[str, Partition]:
        return self.tables.get(table, {})


EMPTY = Snapshot(0, {}, {})


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        folder = self._path(join_uri(self.root, *parts))
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("commits") if n.endswith(".json")]

    def current(self) -> Snapshot:
        versions = self.versions()
        return self.snapshot(versions[-1]) if versions else EMPTY

    def snapshot(self, version: int) -> Snapshot:
        stream = self._fs.open(self._path(join_uri(self.root, "commits", f"{version:012d}.json")))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        raw = json.loads(text)
        tables = {t: {v: Partition(tuple(p["folders"]), p["rows"], p["digest"]) for v, p in parts.items()} for t, parts in raw["tables"].items()}
        return Snapshot(raw["version"], tables, raw["columns"], raw["meta"])

    def begin(self) -> Transaction:
        return Transaction(self, self.current())

    def read(self, table: str, schema: T.StructType, values: Sequence[Any] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
        """Rows of a table at the current (or the given) commit; with ``values`` only
        the folders of those partition values are listed and read."""
        snapshot = snapshot or self.current()
        parts = snapshot.partitions(table)
        wanted = parts if values is None else {t: parts[t] for t in map(partition_text, values) if t in parts}
        return self.read_folders(table, schema, [f for p in wanted.values() for f in p.folders])

    def read_folders(self, table: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = join_uri(self.root, "data", table)
        full = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
        return self.spark.read.schema(full).option("basePath", base).parquet(*[join_uri(base, f) for f in folders]).select(*schema.fieldNames())

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the last ``keep`` commits and delete folders that none of those names.

        A folder carries the number that its writer meant to commit; only numbers
        up to the current one are looked at, so a writer at work is not disturbed,
        whatever any clock says.  Returns the deleted folders.
        """
        versions = self.versions()
        if not versions:
            return []
        kept = [self.snapshot(v) for v in versions[-keep:]]
        used = {(t, f.split("/")[0]) for s in kept for t, parts in s.tables.items() for p in parts.values() for f in p.folders}
        dropped = []
        for table in self._names("data"):
            for name in self._names("data", table):
                if name.startswith("commit=") and int(name[7:19]) <= versions[-1] and (table, name) not in used:
                    self._fs.delete(self._path(join_uri(self.root, "data", table, name)), True)
                    dropped.append(f"{table}/{name}")
        for v in versions[:-keep]:
            self._fs.delete(self._path(join_uri(self.root, "commits", f"{v:012d}.json")), False)
        return dropped


class Transaction:
    """Writes of one commit.  Until ``commit`` nothing of it can be read by others."""

    def __init__(self, store: SnapshotStore, base: Snapshot) -> None:
        self.store, self.base = store, base
        self.version = base.version + 1
        self.folder = f"commit={self.version:012d}-{uuid.uuid4().hex[:8]}"
        self.tables = {t: dict(p) for t, p in base.tables.items()}
        self.columns = dict(base.columns)
        self.writes = 0

    def write(
        self,
        table: str,
        df: DataFrame,
        column: str,
        *,
        values: Sequence[Any] | None = None,
        names: Sequence[str] | None = None,
        append: bool = False,
        layout: str = "cluster",
        tie_cols: Sequence[str] = (),
    ) -> dict[str, Partition]:
        """Write ``df``, split by ``column``; returns the partitions it has.

        They replace the table, or with ``values`` the partitions of those values (the only rows
        of ``df`` that are written), or the partitions of those folder ``names``: one without rows
        any more is gone.  With ``append`` they are added to what is there.
        Rows and digests are counted where the written files are read, one row per partition.
        """
        spark, folder = self.store.spark, f"{self.folder}-{self.writes}"
        self.writes += 1
        path = join_uri(self.store.root, "data", table, folder)
        if values is not None:
            df = df.where(_is_one_of(df, column, values))
        layout_for_write(df, [column], layout, None, tie_cols).write.mode("errorifexists").partitionBy(column).parquet(path)
        written = spark.read.schema(df.schema).parquet(path)
        own = [c for c in df.columns if c != column]
        hashed = F.xxhash64(*[F.col(c) for c in own]) if own else F.lit(0).cast("long")
        text = F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION))
        # The hash is summed in two halves, so that no number of rows overflows a sum.
        sums = [F.count(F.lit(1)).alias("rows"), F.sum(F.shiftright(hashed, 32)).alias("high"), F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")]
        new = {}
        for r in written.groupBy(text.alias("value")).agg(*sums).collect():
            new[r["value"]] = Partition((f"{folder}/{column}={r['value']}",), r["rows"], f"{r['rows']}:{r['high']}:{r['low']}")
        self.put(table, column, new, values if names is None else names, append)
        return new

    def put(self, table: str, column: str, new: Mapping[str, Partition], values: Sequence[Any] | None = None, append: bool = False) -> None:
        """Set the partitions of a table without writing files."""
        old = self.tables.get(table, {})
        if append:
            merged = {v: Partition((*old[v].folders, *p.folders), old[v].rows + p.rows, f"{old[v].digest}+{p.digest}") if v in old else p for v, p in new.items()}
            self.tables[table] = old | merged
        elif values is None:
            self.tables[table] = dict(new)
        else:
            gone = {partition_text(v) for v in values}
            self.tables[table] = {v: p for v, p in old.items() if v not in gone} | dict(new)
        self.columns[table] = column

    def snapshot(self, meta: Mapping[str, Any] | None = None) -> Snapshot:
        return Snapshot(self.version, self.tables, self.columns, {**self.base.meta, **(meta or {})})

    def commit(self, meta: Mapping[str, Any] | None = None) -> Snapshot:
        """Make all writes visible at once; ``meta`` adds to that of earlier commits."""
        done = self.snapshot(meta)
        tables = {t: {v: {"folders": list(p.folders), "rows": p.rows, "digest": p.digest} for v, p in parts.items()} for t, parts in done.tables.items()}
        text = json.dumps({"version": done.version, "tables": tables, "columns": done.columns, "meta": done.meta})
        store = self.store
        target = store._path(join_uri(store.root, "commits", f"{self.version:012d}.json"))
        # The text is complete before its name appears.
        draft = store._path(join_uri(store.root, "drafts", self.folder))
        out = store._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        store._fs.mkdirs(target.getParent())
        if store._fs.exists(target) or not _rename_new(store, draft, target):
            store._fs.delete(draft, False)
            raise CommitConflict(f"commit {self.version} of {store.root} exists")
        return done


def _rename_new(store: SnapshotStore, draft: Any, target: Any) -> bool:
    """Rename where the target must not exist: HDFS and local stores refuse to replace a file."""
    try:
        context = store.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), store.spark._jsc.hadoopConfiguration())
        rename = store.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = store.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context.rename(draft, target, options)
    except Exception as exc:  # noqa: BLE001 - a Java exception: the only one expected says that the target exists
        if "FileAlreadyExists" in str(exc) or "already exists" in str(exc):
            return False
        raise
    return True


def _is_one_of(df: DataFrame, column: str, values: Sequence[Any]):
    some = [v for v in values if v is not None]
    c = F.col(column)
    inside = c.isin(*some) if some else F.lit(False)
    return inside | c.isNull() if len(some) < len(values) else inside


__all__ = ["EMPTY", "NULL_PARTITION", "CommitConflict", "Partition", "Snapshot", "SnapshotStore", "Transaction", "partition_text"]
