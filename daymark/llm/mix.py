"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order.  A copy of a
document gets a virtual finish time: the words its source has sent when the
copy ends, divided by the source's target.  All copies are then range-sorted
by finish time and the sequence is truncated where its running total of words
passes the whole budget.  At any cut the sources have sent words in proportion
to their targets, to within a document.

A source's target is its weight's share of the budget, but at most
``max_epochs`` times its size; what that leaves over is reshared by weight
among the others until no target is above.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.running import running_totals
from daymark.session import shared_dir

WHITE = "\t\n\x0b\x0c\r"


def word_count(text: str | Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``; a null text has none."""
    words = F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")
    return F.coalesce(F.size(words), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Mix:
    """``documents``: every input row with its size, source_size, target, copies and taken
    words; ``stream``: the copies taken, with epoch, finish time and position."""

    documents: DataFrame
    stream: DataFrame


def _targets(sources: DataFrame, budget: float, max_epochs: int) -> DataFrame:
    """Share out the budget.  Each turn sums two columns over the sources; a turn
    that caps no further source is the last."""
    cap = F.col("source_size") * max_epochs
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.count_if(over).alias("n"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("full"),
            F.sum(F.when(~over, F.col("weight"))).alias("open"),
        ).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (budget - row["full"]) / row["open"]
    level = 0.0 if level is None else level
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def mix_sources(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "",
) -> Mix:
    """Mix ``share`` times the words of all rows from the sources of ``docs``.

    Sources by code point (null last, an empty name is a source) weigh
    ``weights``, repeating.  The shuffle key is md5(seed + id), so reruns agree;
    rows that share id and text are interchangeable.  Null and empty texts have
    size 0 and are in the mix when their finish time is; a text of any length is counted whole
    and taken or left as one.  An empty table gives empty results.  ``documents`` has the columns id, source, size, source_size,
    target, copies, taken, text_hash (xxhash64) and row_uid; other input columns are not looked at.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("shuffle_key"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    rows = running_totals(base, ["shuffle_key", "doc_id", "size", "text_hash"], "size", group="source", out_col="sent")

    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumns({"no_name": F.col("source").isNull(), "one": F.lit(1).cast("long")})
    ranked = running_totals(totals, ["no_name", "source"], "one", out_col="place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    path = shared_dir(spark, "mix-sources")
    ranked.select("source", "source_size", "place", weight.cast("long").alias("weight")).write.parquet(path)
    sources = spark.read.parquet(path)
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    targets = _targets(sources, budget, max_epochs)

    s, t = rows.alias("s"), targets.alias("t")
    known = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select("s.*", "t.source_size", "t.place", "t.target")
    finish = lambda e: (F.col("source_size") * (e - 1) + F.col("sent")) / F.col("target")
    fields = ["finish", "place", "epoch", "sent", "row_uid"]
    copies = known.where("target > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))).withColumn("finish", finish(F.col("epoch")))
    ordered = running_totals(copies.drop("shuffle_key", "text_hash"), fields, "size", out_col="position", uid_col="stream_uid")
    stream = ordered.where(F.col("position") <= F.lit(budget))

    # The truncation is one place in the global order: it is found once and
    # then tells for each row which of its copies come before it.
    last = stream.agg(F.max(F.struct(*fields)).alias("x")).first()["x"]
    if last is None:
        n = F.lit(0)
    else:
        cut = F.struct(*[F.lit(last[f]).alias(f) for f in fields])
        at = lambda e: F.struct(finish(e).alias("finish"), "place", F.lit(e).alias("epoch"), "sent", "row_uid")
        n = sum((F.when((F.col("target") > 0) & (at(e) <= cut), 1).otherwise(0) for e in range(1, max_epochs + 1)), F.lit(0))
    documents = known.withColumn("copies", n).withColumn("taken", F.col("copies") * F.col("size"))
    return Mix(documents.drop("shuffle_key", "sent", "place"), stream)


__all__ = ["Mix", "mix_sources", "word_count"]
