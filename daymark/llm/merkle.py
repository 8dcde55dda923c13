"""Document fingerprints: a Merkle tree over paragraphs and sections.

Lines are paragraphs, blank lines part sections.  A paragraph's digest is
sha256 of its text, a section's is sha256 of its paragraphs' digests, the root
is sha256 of the sections' digests.  Below a paragraph, short digests of its
runs of four words tell how much of it is left after an edit.

The fingerprint is a string, ``root/section:paragraph-runs,...``: equal roots
mean equal texts, the paragraphs whose digests differ locate an edit, and the
share of word runs in common is the likeness of two texts.  Everything here is
built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.session import shared_dir

RUN = r"[ \t\x0B\f\r]*(?:[^ \t\x0B\f\r]+[ \t\x0B\f\r]*){1,4}|[ \t\x0B\f\r]+"
ROOT, NODE, LEAF = 32, 8, 6  # hex digits kept of each kind of digest


def _digest(kind: str, content: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), content), 256)


def tree(text: Column) -> Column:
    """array<array<struct<digest, runs>>>: sections of paragraphs."""
    runs = lambda p: F.transform(F.regexp_extract_all(p, F.lit(RUN), F.lit(0)), lambda r: F.substring(F.md5(r), 1, LEAF))
    paragraph = lambda p: F.struct(_digest("p", p).alias("digest"), runs(p).alias("runs"))
    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), paragraph))


def _section(s: Column) -> Column:
    return _digest("s", F.array_join(F.transform(s, lambda p: p["digest"]), ""))


def fingerprint(t: Column) -> Column:
    """The string of a tree."""
    root = _digest("r", F.array_join(F.transform(t, _section), ""))
    paragraph = lambda p: F.concat(F.substring(p["digest"], 1, NODE), F.lit("-"), F.array_join(p["runs"], ""))
    section = lambda s: F.concat(F.substring(_section(s), 1, NODE), F.lit(":"), F.array_join(F.transform(s, paragraph), ","))
    return F.concat(F.substring(root, 1, ROOT), F.lit("/"), F.array_join(F.transform(t, section), "/"))


def word_runs(t: Column) -> Column:
    """The distinct digests of a tree's word runs."""
    return F.array_distinct(F.flatten(F.transform(t, lambda s: F.flatten(F.transform(s, lambda p: p["runs"])))))


def _alike(same: Column, a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(same | (total == 0), F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def _paragraphs(print_: Column) -> Column:
    body = F.substring(print_, ROOT + 2, 2**31 - 1)
    return F.flatten(F.transform(F.split(body, "/"), lambda s: F.split(F.substring(s, NODE + 2, 2**31 - 1), ",")))


def likeness(a: str | Column, b: str | Column) -> Column:
    """0 to 1 for two fingerprints: 1 for equal roots, else the share of word runs in common."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    runs = lambda x: F.array_distinct(F.flatten(F.transform(_paragraphs(x), lambda p: F.regexp_extract_all(F.substring(p, NODE + 2, 2**31 - 1), F.lit(f".{{{LEAF}}}"), F.lit(0)))))
    return _alike(F.substring(a, 1, ROOT) == F.substring(b, 1, ROOT), runs(a), runs(b))


def changed_paragraphs(a: str | Column, b: str | Column) -> Column:
    """Numbers (from 0) of the paragraphs at which two fingerprints' digests differ."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    digests = lambda x: F.transform(_paragraphs(x), lambda p: F.substring(p, 1, NODE))
    both = F.arrays_zip(digests(a).alias("a"), digests(b).alias("b"))
    at = F.transform(both, lambda x, i: F.when(x["a"].eqNullSafe(x["b"]), F.lit(None)).otherwise(i))
    return F.when(F.substring(a, 1, ROOT) == F.substring(b, 1, ROOT), F.array().cast("array<int>")).otherwise(F.array_compact(at))


def fingerprint_documents(docs: DataFrame, *, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` plus ``out_col``; a null text counts as empty, an input
    column named like ``out_col`` is replaced."""
    kept = docs.drop(out_col)
    return kept.withColumn("__tree", tree(F.coalesce(F.col(text_col), F.lit("")))).withColumn(out_col, fingerprint(F.col("__tree"))).drop("__tree")


def followed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, n_chars, next_id, next_th): each distinct document and the next one
    by ascending id, the first after the last.  ``th`` is a hash of the text.

    The rows' places in a range-partitioned order are written once; a row's
    follower is the next place in its part, or the first of the next part.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "followed")
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), F.length(text).cast("long").alias("n_chars")).distinct()
    placed = slim.repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th").withColumn("place", F.monotonically_increasing_id())
    placed.write.parquet(f"{root}/places")
    rows = spark.read.schema(placed.schema).parquet(f"{root}/places").withColumn("part", F.shiftright("place", 33))
    # One row per part.
    parts = rows.groupBy("part").agg(F.max("place").alias("last"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = parts.withColumn("next_part", F.coalesce(F.lead("part").over(order), F.min("part").over(whole)))
    known = rows.join(F.broadcast(after), "part")
    known = known.withColumn("next_place", F.when(F.col("place") < F.col("last"), F.col("place") + 1).otherwise(F.shiftleft("next_part", 33)))
    names = rows.select(F.col("place").alias("next_place"), F.col("doc_id").alias("next_id"), F.col("th").alias("next_th"))
    known.join(names, "next_place").select("doc_id", "th", "n_chars", "next_id", "next_th").write.parquet(f"{root}/next")
    return spark.read.parquet(f"{root}/next")


def edit_likeness(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness.

    The edited text has its last floor(n_chars / 4) code points replaced by the
    first as many (or all) of the next document's, in ascending id order, the
    first after the last.  Null texts are empty.  Rows equal in id and text are
    one document in that order and each get its result; rows that share an id
    only follow each other by a hash of their texts; a single document follows
    itself; an empty table gives an empty result.

    Texts are exchanged once: the next document's beginning and word runs are
    made where that text lies and sent to the document before it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    following = followed(docs, id_col, text_col)
    asked = following.select(F.col("doc_id").alias("for_id"), F.col("th").alias("for_th"), F.floor(F.col("n_chars") / 4).cast("int").alias("n"), "next_id", "next_th")
    t, a = texts.alias("t"), asked.alias("a")
    met = t.join(a, F.col("t.doc_id").eqNullSafe(F.col("a.next_id")) & (F.col("t.th") == F.col("a.next_th")))
    sent = met.select("for_id", "for_th", "n", F.substring("t.text", F.lit(1), F.col("n")).alias("begin"), tree(F.col("t.text")).alias("next_tree"))
    sent = sent.select("for_id", "for_th", "n", "begin", word_runs(F.col("next_tree")).alias("next_runs"), F.substring(fingerprint(F.col("next_tree")), 1, ROOT).alias("next_root"))
    if docs.count() > following.count():
        # A repeated document sends its beginning once for each of its rows.
        sent = sent.dropDuplicates(["for_id", "for_th"])
    both = t.join(sent.alias("s"), F.col("t.doc_id").eqNullSafe(F.col("s.for_id")) & (F.col("t.th") == F.col("s.for_th")))
    n_chars = F.length("text").cast("long")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n_chars - F.col("n")).cast("int")), F.col("begin"))
    trees = both.select("doc_id", n_chars.alias("n_chars"), tree(F.col("text")).alias("tree"), edited.alias("edited"), "next_runs", "next_root")
    trees = trees.withColumns({"edited_sha256": F.sha2("edited", 256), "edited_tree": tree(F.col("edited"))})
    prints = trees.select("*", fingerprint(F.col("tree")).alias("fingerprint"), fingerprint(F.col("edited_tree")).alias("edited_fingerprint"), word_runs(F.col("tree")).alias("runs"), word_runs(F.col("edited_tree")).alias("edited_runs"))
    root = F.substring("fingerprint", 1, ROOT)
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        _alike(root == F.substring("edited_fingerprint", 1, ROOT), F.col("runs"), F.col("edited_runs")).alias("near_edited"),
        _alike(root == F.col("next_root"), F.col("runs"), F.col("next_runs")).alias("near_next"),
    )


__all__ = ["changed_paragraphs", "edit_likeness", "fingerprint", "fingerprint_documents", "likeness", "tree", "word_runs"]
