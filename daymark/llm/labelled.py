"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.session import shared_dir


def in_fold(ident: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves the remainder."""
    return F.coalesce(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, max_per_class: int) -> DataFrame:
    """(text, label 0/1) of up to ``max_per_class`` usable labelled ids of each class, written
    once to the shared folder.

    The ids of a class with the smallest hashes are taken, so reruns agree; they are
    the only side that is broadcast.  An id counts once, whatever rows repeat it: with its
    greatest label and the least of its texts (null counts as empty).  Rows whose label is
    null or which have no document are left out.
    """
    spark = docs.sparkSession
    known = labels.where(usable & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("__label"))
    taken = [known.where(F.col("__label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for y in (0, 1)]
    ids = F.broadcast(taken[0].union(taken[1]))
    met = docs.join(ids, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "__label")
    path = shared_dir(spark, "labelled")
    met.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("__label").alias("label")).select("text", "label").write.parquet(path)
    return spark.read.parquet(path)


__all__ = ["in_fold", "labelled_sample"]
