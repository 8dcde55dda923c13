"""Running totals over a global order, without a single task that sees all rows.

The rows are range-partitioned by the order, summed while each partition
streams by, and written to the shared folder (so that partitions and sums are
fixed for all later steps, also when executors are lost).  What a partition
must add is the sum of the last values of the partitions before it: a table of
one row per partition and group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.session import shared_dir


def _group_sums(values: np.ndarray, fresh: np.ndarray, carry: int) -> np.ndarray:
    """Inclusive sums that begin anew where ``fresh`` is set; the first run adds ``carry``."""
    total = np.cumsum(values)
    starts = np.flatnonzero(fresh)
    base = np.zeros(len(values), dtype=np.int64)
    base[: starts[0] if len(starts) else len(values)] = -carry
    for a, b in zip(starts, [*starts[1:], len(values)]):
        base[a:b] = total[a - 1] if a else 0
    return total - base


def running_totals(df: DataFrame, order: list[str], value: str, *, group: str | None = None, out_col: str = "running", uid_col: str = "row_uid") -> DataFrame:
    """``df`` plus ``out_col`` (sum of the long ``value`` up to and with the row) and ``uid_col``.

    The order is ascending by the columns of ``order``, after ``group`` if
    given, whose values have totals of their own.  Rows that tie in all of
    ``order`` follow each other in a fixed but unspecified order, which
    ``uid_col`` (unique, ascending) tells.  ``value`` must not be null.
    """
    spark = df.sparkSession
    by = [*([group] if group else []), *order]
    schema = T.StructType(
        [*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__sum", T.LongType()), T.StructField(uid_col, T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, carry, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False)
            fresh = np.zeros(n, dtype=bool)
            if group:
                codes = batch.column(group).dictionary_encode(null_encoding="encode")
                ids = codes.indices.to_numpy(zero_copy_only=False)
                fresh[1:] = ids[1:] != ids[:-1]
                first, now = codes.dictionary[int(ids[0])].as_py(), codes.dictionary[int(ids[-1])].as_py()
                fresh[0] = at > 0 and first != last
                last = now
            sums = _group_sums(values, fresh, carry)
            carry = int(sums[-1])
            uid = (np.int64(part) << 40) + np.arange(at, at + n)
            at += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(sums), pa.array(uid)], [*batch.schema.names, "__part", "__sum", uid_col]
            )

    path = shared_dir(spark, "running")
    df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    # At most one row per partition and one more per group.
    keys = [*([group] if group else []), "__part"]
    window = Window.partitionBy(group) if group else Window.partitionBy()
    window = window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*keys).agg(F.max("__sum").alias("__end"))
    ends = ends.withColumn("__before", F.coalesce(F.sum("__end").over(window), F.lit(0))).where("__before <> 0")
    same = F.col("a.__part") == F.col("b.__part")
    if group:
        same &= F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}"))
    # Only partitions that a group enters with a sum are left: one row each.
    joined = rows.alias("a").join(F.broadcast(ends.select(*keys, "__before").alias("b")), same, "left")
    total = F.col("a.__sum") + F.coalesce(F.col("b.__before"), F.lit(0))
    return joined.select(*[F.col(f"a.{c}") for c in df.columns if c != out_col], total.alias(out_col), f"a.{uid_col}")


__all__ = ["running_totals"]
