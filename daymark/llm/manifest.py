"""A Merkle manifest of a dataset that keeps only every few levels.

Each row is a leaf.  The leaves of a group are numbered by their order and
hashed ``fan_out`` at a time until one node, the group's subroot, remains; the
subroots are hashed alike to the root.  Written to the manifest are the leaves
and every ``stride``-th level above them.  A level that is not written is
recomputed when a proof needs it: the stored nodes below one stored node form
an aligned subtree (``fan_out ** stride`` nodes at most, a fixed number), from
which the levels between are hashed anew, give their siblings and are dropped.

No task sees a group as a whole: leaves are numbered by running totals over
range partitions, and a shuffle key is (group, number of the aligned subtree).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.running import running_totals

FAN_OUT = 16
STRIDE = 2
#: The group of the subroots themselves.
TOP = "top"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_name(source: Column) -> Column:
    """A never-null name that sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _run(nodes: Column, run: Column, fan_out: int) -> Column:
    return F.slice(nodes, run * fan_out + 1, fan_out)


def _joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _width(leaves: Column, level: int, fan_out: int) -> Column:
    """Nodes of a level over so many leaves."""
    return F.ceil(leaves / F.lit(fan_out**level)).cast("long")


def _level_above(nodes: Column, fan_out: int) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / F.lit(fan_out)).cast("int"))
    return F.transform(runs, lambda r: digest(_joined(_run(nodes, r, fan_out))))


def _levels(stored: Column, stride: int, fan_out: int) -> list[Column]:
    """The stored nodes of an aligned subtree and the levels above them, up to
    the next stored one, as arrays of digests."""
    levels = [stored]
    for _ in range(stride):
        levels.append(_level_above(levels[-1], fan_out))
    return levels


@dataclass(frozen=True)
class Manifest:
    """Folders of the stored levels, and the root (of no rows: the digest of no text)."""

    path: str
    root: str
    stored: tuple[int, ...]
    stored_top: tuple[int, ...]
    fan_out: int = FAN_OUT
    stride: int = STRIDE
    kept: tuple[str, ...] = ()

    def level(self, spark: SparkSession, level: int, *, top: bool = False) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{'top' if top else 'rows'}/level={level}")

    def subroots(self, spark: SparkSession) -> DataFrame:
        """(group, source, n leaves, subroot)."""
        return spark.read.parquet(f"{self.path}/subroots")


def _subtrees(nodes: DataFrame, stride: int, fan_out: int, *extra: str) -> DataFrame:
    """One row per aligned subtree: its stored nodes in order (``fan_out ** stride`` at most)."""
    span = fan_out**stride
    block = F.floor(F.col("place") / F.lit(span)).cast("long")
    fields = ["place", "digest", *extra]
    return nodes.groupBy("tree", block.alias("block"), "n").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))


def _write_levels(spark: SparkSession, path: str, stride: int, fan_out: int) -> tuple[list[int], DataFrame]:
    """Hash the stored level 0 under ``path`` upwards, writing every ``stride``-th level.

    Returns the levels written and the last node of each tree.  A tree that
    ends between two stored levels gives its last node from there.
    """
    levels, ends = [0], []
    while True:
        at = levels[-1]
        nodes = spark.read.parquet(f"{path}/level={at}").select("tree", "place", "n", "digest")
        ends.append(nodes.where(_width(F.col("n"), at, fan_out) == 1).select("tree", "digest"))
        open_ = nodes.where(_width(F.col("n"), at, fan_out) > 1)
        if not open_.take(1):
            return levels, _union(ends)
        built = _levels(F.col("nodes.digest"), stride, fan_out)
        # In a tree that ends on the way, the first level of one node is its last.
        height = sum(((_width(F.col("n"), at + j, fan_out) > 1).cast("int") for j in range(1, stride)), F.lit(1))
        last = F.when(height == 1, built[1][0])
        for j in range(2, stride + 1):
            last = last.when(height == j, built[j][0])
        ended = _width(F.col("n"), at + stride, fan_out) == 1
        up = _subtrees(open_, stride, fan_out).select("tree", F.col("block").alias("place"), "n", last.alias("digest"), ended.alias("ended"))
        up.write.parquet(f"{path}/level={at + stride}")
        levels.append(at + stride)
        if not spark.read.parquet(f"{path}/level={at + stride}").where("not ended").take(1):
            ends.append(spark.read.parquet(f"{path}/level={at + stride}").where("ended").select("tree", "digest"))
            return levels, _union(ends)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def write_manifest(
    rows: DataFrame,
    path: str,
    *,
    leaf: Column,
    source_col: str = "source",
    order_col: str = "doc_id",
    keep: dict[str, Column] | None = None,
    fan_out: int = FAN_OUT,
    stride: int = STRIDE,
) -> Manifest:
    """Hash ``rows`` to a manifest in the (new) folder ``path``.

    ``leaf`` is a row's digest; a null source is a group of its own, before all
    others.  Leaves ascend by ``order_col``, null first; rows that tie there
    ascend by their digest, so equal rows are leaves of their own and the root
    does not depend on how rows lie in files.  Columns given by ``keep`` are
    stored beside the leaves; all other input columns are only seen by ``leaf``,
    so clashing names do no harm.  Texts are hashed where they are read and do
    not leave their task, whatever their length.  An empty table has the digest of no text as its root.
    """
    spark = rows.sparkSession
    kept = {k: v for k, v in (keep or {}).items()}
    base = rows.select(
        group_name(F.col(source_col)).alias("tree"),
        F.col(source_col).alias("source"),
        F.col(order_col).alias("ident"),
        leaf.alias("digest"),
        F.lit(1).cast("long").alias("one"),
        *[v.alias(f"keep_{k}") for k, v in kept.items()],
    )
    counted = running_totals(base, ["ident", "digest", *[f"keep_{k}" for k in kept]], "one", group="tree", out_col="place")
    raw = f"{path}/numbered"
    counted.withColumn("place", F.col("place") - 1).drop("one", "row_uid").write.parquet(raw)
    numbered = spark.read.parquet(raw)
    sizes = numbered.groupBy("tree").agg(F.count("*").alias("n"), F.first("source").alias("source"))
    sizes.write.parquet(f"{path}/sizes")
    sizes = spark.read.parquet(f"{path}/sizes")
    leaves = numbered.join(sizes.select("tree", "n"), "tree")
    leaves.write.parquet(f"{path}/rows/level=0")
    stored, ends = _write_levels(spark, f"{path}/rows", stride, fan_out)
    ends.join(sizes, "tree").withColumnRenamed("digest", "subroot").write.parquet(f"{path}/subroots")

    subroots = spark.read.parquet(f"{path}/subroots").select(F.lit(TOP).alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("digest"), F.lit(1).cast("long").alias("one"))
    n = sizes.count()
    placed = running_totals(subroots, ["group"], "one", out_col="place")
    placed.select("tree", "group", (F.col("place") - 1).alias("place"), F.lit(n).cast("long").alias("n"), "digest").write.parquet(f"{path}/top/level=0")
    stored_top, end = _write_levels(spark, f"{path}/top", stride, fan_out)
    last = end.first()
    root = last["digest"] if last else spark.range(1).select(digest(F.lit(""))).first()[0]
    return Manifest(path, root, tuple(stored), tuple(stored_top), fan_out, stride, tuple(kept))


def _paths(nodes: DataFrame, above: DataFrame, level: int, m: Manifest, *extra: str) -> DataFrame:
    """For each stored node of a level its path: an array of (left, right), the joined
    digests of its run's others before and after it, level by level.

    The levels up to the next stored one are hashed from the aligned subtree; the path from
    there on comes with ``above`` (tree, place, path, subroot), one row per subtree.
    """
    upper = above.select(F.col("tree").alias("__tree"), F.col("place").alias("__place"), F.col("path").alias("upper"), "subroot")
    trees = _subtrees(nodes, m.stride, m.fan_out, *extra)
    trees = trees.join(upper, (F.col("tree") == F.col("__tree")) & (F.col("block") == F.col("__place")))
    built = _levels(F.col("nodes.digest"), m.stride, m.fan_out)
    trees = trees.withColumns({f"l{j}": built[j] for j in range(m.stride)})
    rows = trees.select("tree", "n", "upper", "subroot", *[f"l{j}" for j in range(m.stride)], F.posexplode("nodes").alias("i", "node"))
    steps = []
    for j in range(m.stride):
        at = F.floor(F.col("i") / F.lit(m.fan_out**j)).cast("int")
        run = _run(F.col(f"l{j}"), F.floor(at / F.lit(m.fan_out)).cast("int"), m.fan_out)
        own = at % m.fan_out
        others = F.struct(_joined(F.slice(run, F.lit(1), own)).alias("left"), _joined(F.slice(run, own + 2, m.fan_out)).alias("right"))
        steps.append(F.when(_width(F.col("n"), level + j, m.fan_out) > 1, others))
    path = F.concat(F.filter(F.array(*steps), lambda s: s.isNotNull()), F.col("upper"))
    return rows.select("tree", F.col("node.place").alias("place"), F.col("node.digest").alias("digest"), path.alias("path"), "subroot", *[F.col(f"node.{c}").alias(c) for c in extra])


def _tree_paths(spark: SparkSession, m: Manifest, ends: DataFrame, extra: tuple[str, ...], *, top: bool = False) -> DataFrame:
    """Paths of all level-0 nodes, found from the highest stored level downwards.

    ``ends`` has the (tree, n, path, subroot) of each tree's last node; its path is taken up by the
    one subtree that the tree ends in.
    """
    levels, above = m.stored_top if top else m.stored, None
    for level in [x for x in reversed(levels) if x < levels[-1] or x == 0]:
        nodes = m.level(spark, level, top=top)
        if level:
            nodes = nodes.where(_width(F.col("n"), level, m.fan_out) > 1)
        last = ends.where(_width(F.col("n"), level + m.stride, m.fan_out) == 1).select("tree", F.lit(0).cast("long").alias("place"), "path", "subroot")
        above = _paths(nodes, last if above is None else above.select(*last.columns).union(last), level, m, *(extra if level == 0 else ()))
    return above


def proofs(spark: SparkSession, m: Manifest) -> DataFrame:
    """(source, ident, leaf, subroot, path, kept columns) of every leaf.

    ``path`` leads from the leaf via the subroot to the root; an element holds the
    joined digests of the run's others to the left and to the right, both empty for a run
    of one.  Paths are made in the task of their subtree and not stored.
    """
    groups = m.subroots(spark).select("tree", "n", "subroot")
    none = F.array().cast("array<struct<left:string,right:string>>")
    whole = groups.agg(F.count("*").alias("n")).select(F.lit(TOP).alias("tree"), "n", none.alias("path"), F.lit(m.root).alias("subroot"))
    top = _tree_paths(spark, m, whole, ("group",), top=True)
    ends = groups.join(top.select(F.col("group").alias("tree"), "path"), "tree")
    own = _tree_paths(spark, m, ends, ("source", "ident", *[f"keep_{k}" for k in m.kept]))
    return own.select("source", "ident", F.col("digest").alias("leaf"), "subroot", "path", *[F.col(f"keep_{k}").alias(k) for k in m.kept])


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, joined."""
    return _joined(F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def document_leaf(text: Column) -> Column:
    """The digest of a row of ``documents`` with that text."""
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, no other letter."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


__all__ = ["Manifest", "ascii_lower", "digest", "document_leaf", "field", "fold", "proofs", "siblings", "write_manifest"]
