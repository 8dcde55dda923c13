"""Exact n-gram Jaccard self-join and its connected components.

Documents with equal shingle sets are one class from the first scan on.  A
class pair of similarity t or more must share a token among the first
``n - ceil(t n) + 1`` tokens of both sets under any global token order
(prefix filter).  Several orders are used: candidates are found through the
postings of the first one, rarest tokens first, and must also share a prefix
token under every other order before their sets are compared.

* A class that links shares a least number of its first tokens in hash order,
  about a quarter of all, with other classes.  These are sent first; the texts of
  classes with fewer go no further, and the next steps see the others only.
* Token counts are exact over those.  Each task sends every range of
  the token space one packed block (sorted token gaps, local class numbers),
  a token that no second class has goes no further.  Tokens in more than
  1/64 of the classes are known from the first scan; they rank last, and
  their rows are dealt by task, not by token.
* A posting also tells the token's place in its set, which bounds what two sets
  can have in common from their first shared token on (positional filter); token
  counts by 64 hash values bound it again.
* Links are found in rounds.  In a leader round every posting list compares
  its members with a few of them, so that the comparisons of a group of near
  copies grow with its size; the components so far are merged.  In the
  rounds after it the pairs left, those of different components that share a
  prefix token, are all compared unless the bounds of a whole component exclude it,
  first a small share of them: what that merges need not be compared again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.key_filter import key_filter, split
from daymark.llm.words import mix64, pieces, shingle_sets
from daymark.llm.worker import free_other_stages
from daymark.session import shared_dir

FLUSH_TOKENS = 3_000_000
FLUSH_CLASSES = 60_000
PART_TOKENS = 1_500_000
HEAVY_SHARE = 64
HEAVY_CLASS = 127
LEADER_ROUNDS = 1
LEADERS = 8
COUNTERS = 64
COUNTER_TOP = 32_767  # a counter of this value says "so many or more"
# A class must share one in so many of its tokens, among its first ones in hash order, before all of them are sent.
SCREEN = 16
# Shares of the pairs left that the last rounds compare, in sixteenths from and to.
PAIR_SHARES = ((0, 1), (1, 4), (4, 16))
_SEED = np.uint64(0x51ED270B27A1C9F5)


def _classes(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set: it depends on the members and their number only."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(tokens + _SEED))])
    n = np.diff(at).astype(np.uint64)
    return mix64(sums[at[1:]] - sums[at[:-1]] + n * _SEED).view(np.int64)


class _Block:
    """The sets of the distinct classes a task has read since it last sent a block."""

    def __init__(self) -> None:
        self.tokens: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list[int] = []
        self.seen: set[int] = set()
        self.n = 0

    def add(self, tokens: np.ndarray, at: np.ndarray, ids: np.ndarray) -> None:
        new = []
        for row, own in enumerate(ids.tolist()):
            if own not in self.seen and at[row + 1] > at[row]:
                self.seen.add(own)
                self.ids.append(own)
                new.append(row)
        sizes = np.diff(at)
        keep = np.zeros(len(sizes), dtype=bool)
        keep[new] = True
        self.tokens.append(tokens[np.repeat(keep, sizes)])
        self.sizes.append(sizes[keep])
        self.n += len(self.tokens[-1])

    def full(self) -> bool:
        return self.n >= FLUSH_TOKENS or len(self.ids) >= FLUSH_CLASSES

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        tokens = np.concatenate(self.tokens) if self.tokens else np.zeros(0, np.uint64)
        # A block is asked whether it is full after a whole piece only, and may pass 65,536 classes.
        local = np.repeat(np.arange(len(self.ids), dtype=np.uint32), np.concatenate(self.sizes) if self.sizes else [])
        order = np.argsort(tokens, kind="stable")
        return tokens[order], local[order]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal significance together: the high ones, mostly zero, compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplane(raw: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _pack(tokens: np.ndarray, local: np.ndarray, ids: np.ndarray) -> bytes:
    gaps = np.diff(tokens, prepend=np.uint64(0))
    wide = bool(len(gaps)) and int(gaps.max()) >= 2**32
    used, local = np.unique(local, return_inverse=True)
    many = len(used) > 2**16
    return b"".join(
        [struct.pack("<??II", wide, many, len(tokens), len(used)), _planes(gaps if wide else gaps.astype("<u4")), _planes(local.astype("<u4" if many else "<u2")), ids[used].tobytes()]
    )


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide, many, n, n_ids = struct.unpack_from("<??II", raw)
    at = struct.calcsize("<??II")
    width, more = 8 if wide else 4, 4 if many else 2
    gaps = _unplane(raw[at : at + width * n], f"<u{width}") if n else np.zeros(0, np.uint64)
    local = _unplane(raw[at + width * n : at + (width + more) * n], f"<u{more}") if n else np.zeros(0, np.uint16)
    ids = np.frombuffer(raw, "<i8", n_ids, at + (width + more) * n)
    return np.cumsum(gaps.astype(np.uint64)), ids[local]


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, tokens, offsets and class ids, a few MB of text at a time."""
    free_other_stages()
    for batch in batches:
        for lo, hi in pieces(batch.column(1)):
            tokens, at = shingle_sets(batch.column(1).slice(lo, hi - lo))
            yield batch.slice(lo, hi - lo), tokens, at, _classes(tokens, at)


def _profile(docs: DataFrame, path: str) -> None:
    """Write (kind 0) each row's id, set size, class and text hash, (1) counts of tokens that
    many classes of a block share, (2) the number of classes of each block."""

    names = ["kind", "doc_id", "n", "class", "text_hash"]

    def block_rows(block: _Block) -> pa.RecordBatch:
        tokens, _ = block.sorted()
        ends = np.flatnonzero(np.append(tokens[1:] != tokens[:-1], True)) if len(tokens) else np.zeros(0, int)
        counts = np.diff(ends, prepend=-1)
        many = counts >= max(16, len(block.ids) // HEAVY_SHARE)
        kinds = np.append(np.ones(many.sum(), np.int32), np.int32(2))
        size = np.append(counts[many], len(block.ids))
        own = np.append(tokens[ends[many]].view(np.int64), 0)
        return pa.RecordBatch.from_arrays([pa.array(kinds), pa.nulls(len(kinds), pa.int64()), pa.array(size.astype(np.int64)), pa.array(own), pa.nulls(len(kinds), pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for rows, tokens, at, ids in _read_blocks(batches):
            block.add(tokens, at, ids)
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), rows.column(0).cast(pa.int64()), pa.array(np.diff(at).astype(np.int64)), pa.array(ids), rows.column(2)], names)
            if block.full():
                yield block_rows(block)
                block = _Block()
        yield block_rows(block)

    docs.mapInArrow(run, "kind int, doc_id long, n long, class long, text_hash long").write.parquet(path)


def _sent(block: _Block, heavy: np.ndarray, n_parts: int, turn: int) -> pa.RecordBatch:
    """(part, block): a packed block of each range of the token space that has tokens, and one of the heavy tokens."""
    bits = n_parts.bit_length() - 1
    tokens, local = block.sorted()
    ids = np.array(block.ids, dtype=np.int64)
    is_heavy = np.isin(tokens, heavy, assume_unique=False)
    parts, blobs = [], []
    if is_heavy.any():
        parts.append(n_parts + TaskContext.get().partitionId() * 1000 + turn)
        blobs.append(_pack(tokens[is_heavy] >> np.uint64(8), local[is_heavy], ids))
    tokens, local = tokens[~is_heavy] >> np.uint64(8), local[~is_heavy]
    which = tokens >> np.uint64(56 - bits) if bits else np.zeros(len(tokens), np.uint64)
    edges = np.searchsorted(which, np.arange(n_parts + 1, dtype=np.uint64))
    low = np.uint64((1 << (56 - bits)) - 1)
    for part in np.flatnonzero(np.diff(edges)):
        a, b = edges[part], edges[part + 1]
        parts.append(int(part))
        blobs.append(_pack(tokens[a:b] & low, local[a:b], ids))
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], ["part", "block"])


def _shared_tokens(blocks: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens and classes of packed blocks, each pair once, sorted, and the number of classes of each token."""
    both = [_unpack(b) for b in blocks]
    tokens = np.concatenate([x[0] for x in both])
    ids = np.concatenate([x[1] for x in both])
    order = np.lexsort((ids, tokens))
    tokens, ids = tokens[order], ids[order]
    fresh = np.ones(len(tokens), dtype=bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])
    tokens, ids = tokens[fresh], ids[fresh]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    return tokens, ids, np.diff(np.append(first, len(tokens)))


def _least(n: np.ndarray, percent: int) -> np.ndarray:
    """What a set of n tokens has in common at least with any set it links with."""
    return (percent * n + 99) // 100


def _screened(n: np.ndarray, percent: int) -> np.ndarray:
    """Linked sets share so many of their first ``n - least + screened`` tokens: the lesser one's number."""
    return np.minimum(_least(n, percent), n // SCREEN + 1)


def _enough(n: str, found: str, percent: int) -> Column:
    """Whether that many found tokens allow a link: a set it links with has ``_least`` tokens or more."""
    least = F.expr(f"({percent} * {n} + 99) div 100")
    return F.col(found) >= F.least(F.expr(f"({percent} * (({percent} * {n} + 99) div 100) + 99) div 100"), F.floor(least / SCREEN) + 1)


def _found_in_others(docs: DataFrame, heavy: np.ndarray, n_parts: int, percent: int) -> DataFrame:
    """(class, found): how many of a class's first tokens in hash order are among those of another class, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, block = 0, _Block()
        for _, tokens, at, ids in _read_blocks(batches):
            n = np.diff(at)
            first = n - _least(n, percent) + _screened(n, percent)
            own = np.arange(len(tokens)) - np.repeat(at[:-1], n) < np.repeat(first, n)
            block.add(tokens[own], np.concatenate([[0], np.cumsum(first)]), ids)
            if block.full():
                yield _sent(block, heavy, n_parts, turn)
                turn, block = turn + 1, _Block()
        yield _sent(block, heavy, n_parts, turn)

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Several classes of a block have a heavy token.
        if int(key[0]) >= n_parts:
            ids = np.concatenate([_unpack(b)[1] for b in rows["block"]])
        else:
            _, ids, df = _shared_tokens(rows["block"])
            ids = ids[np.repeat(df > 1, df)]
        own, found = np.unique(ids, return_counts=True)
        return pd.DataFrame({"class": own, "found": found.astype(np.int64)})

    blocks = docs.mapInArrow(run, "part long, block binary")
    return blocks.groupBy("part").applyInPandas(count, "class long, found long")


def _repeated_tokens(docs: DataFrame, heavy: np.ndarray, n_parts: int) -> DataFrame:
    """(class, key) for every token that two or more classes have.

    A key sorts by token count (in steps), then token; it names 56 bits of the
    token.  The count step of heavy tokens is the last.
    """
    bits = n_parts.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, block = 0, _Block()
        for _, tokens, at, ids in _read_blocks(batches):
            block.add(tokens, at, ids)
            if block.full():
                yield _sent(block, heavy, n_parts, turn)
                turn, block = turn + 1, _Block()
        yield _sent(block, heavy, n_parts, turn)

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        if part >= n_parts:
            both = [_unpack(b) for b in rows["block"]]
            keys = np.concatenate([x[0] for x in both]) + np.uint64(HEAVY_CLASS << 56)
            return pd.DataFrame({"class": np.concatenate([x[1] for x in both]), "key": keys.view(np.int64)})
        tokens, ids, df = _shared_tokens(rows["block"])
        step = np.minimum(HEAVY_CLASS - 1, 6 * np.log2(df)).astype(np.uint64)
        keep = np.repeat(df > 1, df)
        keys = (np.repeat(step, df) << np.uint64(56)) + (np.uint64(part) << np.uint64(56 - bits)) + tokens
        return pd.DataFrame({"class": ids[keep], "key": keys[keep].view(np.int64)})

    blocks = docs.mapInArrow(run, "part long, block binary")
    return blocks.groupBy("part").applyInPandas(count, "class long, key long")


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v): root is the component's least node.

    Alternating large-star and small-star steps; each works on one edge at a
    time and takes minima with partial sums, so a node of any degree is fine.
    """
    path = shared_dir(spark, "components")
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    turn, before = 0, None
    edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().write.parquet(f"{path}/0")
    while True:
        e = spark.read.parquet(f"{path}/{turn}")
        state = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == before:
            break
        before = state
        # Large star: larger neighbours move to the least neighbour.
        near = both(e)
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours move to the least of them.
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turn += 1
        small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().write.parquet(f"{path}/{turn}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _scrambled(order: int) -> Column:
    """The keys with their places in another token order."""
    return F.transform("keys", lambda k: F.struct(F.xxhash64(k, F.lit(order)).alias("o"), k.alias("k")))


def _counters(keys: str) -> Column:
    """Token counts by the last bits of the key: the sum of the lesser counts of two sets bounds what they share."""
    count = lambda i: F.size(F.filter(keys, lambda k: F.pmod(k, F.lit(COUNTERS)) == i))
    return F.transform(F.sequence(F.lit(0), F.lit(COUNTERS - 1)), lambda i: F.least(count(i), F.lit(COUNTER_TOP)).cast("short"))


def _most_common(a: str, b: str, size: str = "n") -> str:
    """What the sets ``a`` and ``b`` can share by their counters; two full ones bound nothing."""
    least = f"if(least(x, y) = {COUNTER_TOP}, bigint(least({a}.n, {b}.{size})), bigint(least(x, y)))"
    return f"aggregate(zip_with({a}.counts, {b}.counts, (x, y) -> {least}), 0L, (s, x) -> s + x)"


def _verified(pairs: DataFrame, active: DataFrame, percent: int, orders: int) -> DataFrame:
    """Pairs (a, b) that share a prefix token under every other order and are similar enough."""
    side = lambda s: active.select(*[F.col(c).alias(f"{c}_{s}") for c in ("class", "n", "keys")])
    first = pairs
    if orders > 1:
        cols = ["class", *[f"prefix{i}" for i in range(2, orders + 1)]]
        slim = lambda s: active.select(*[F.col(c).alias(f"{c}_{s}") for c in cols])
        first = pairs.join(slim("a"), F.col("a") == F.col("class_a")).join(slim("b"), F.col("b") == F.col("class_b"))
        for i in range(2, orders + 1):
            first = first.where(F.arrays_overlap(f"prefix{i}_a", f"prefix{i}_b"))
        first = first.select("a", "b")
    full = first.join(side("a"), F.col("a") == F.col("class_a"))
    full = full.join(side("b"), F.col("b") == F.col("class_b"))
    full = full.withColumn("common", F.size(F.array_intersect("keys_a", "keys_b")))
    return full.where(F.expr(f"100 * common >= {percent} * (n_a + n_b - common)")).select("a", "b")


def jaccard_components(
    docs: DataFrame, *, percent: int = 80, orders: int = 3, id_col: str = "doc_id", text_col: str = "text", row_keys: bool = False
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Two documents link when the Jaccard similarity of their sets of 5-word
    shingles is ``percent`` / 100 or more; component_id is the smallest id
    reachable by links.  Null and empty texts, and texts without words, have no
    shingles and link with nothing; repeated rows are linked copies; other
    columns are not looked at; an empty table gives an empty result.  Classes
    are told apart by 64-bit hashes of their sets, tokens by 56 bits.
    With ``row_keys`` also text_hash, which with the id tells rows of different
    texts apart, and component, which tells components apart that share their
    smallest id or have none (null for a row without shingles).
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "jaccard")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    _profile(texts.withColumn("text_hash", F.xxhash64("text")), f"{root}/profile")
    profile = spark.read.parquet(f"{root}/profile")
    hashes = profile.where("kind = 0 and n > 0").select("class", "text_hash")
    rows = profile.where("kind = 0").select("doc_id", "n", "class", *(["text_hash"] if row_keys else []))

    size = profile.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("n"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(F.col("kind") == 2, F.col("n"))), F.lit(0)).alias("classes"),
    ).first()
    # At most 64 times the mean set size, whatever the number of rows.
    counts = profile.where("kind = 1").groupBy("class").agg(F.sum("n").alias("n"))
    heavy = np.sort(np.array([r[0] for r in counts.where(F.col("n") * HEAVY_SHARE >= max(1024, size["classes"])).select("class").collect()], dtype=np.int64).view(np.uint64))
    n_parts = lambda tokens: 1 << max(0, int(tokens // PART_TOKENS).bit_length())

    classes = rows.where("n > 0").groupBy("class").agg(F.first("n").alias("n"))
    found = _found_in_others(texts, heavy, n_parts(size["tokens"] * (100 - percent) // 100 + size["tokens"] // SCREEN), percent)
    enough = classes.join(found.groupBy("class").agg(F.sum("found").alias("found")), "class").where(_enough("n", "found", percent))
    enough.select("class", "n").write.parquet(f"{root}/enough")
    enough = spark.read.parquet(f"{root}/enough")
    # All rows of these classes, and a few others; a text's hash tells them before the text is read.
    key_filter(hashes.join(enough, "class", "left_semi").select("text_hash").distinct()).write.parquet(f"{root}/held")
    near, _ = split(texts, F.xxhash64("text"), spark.read.parquet(f"{root}/held"))
    left = enough.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()["tokens"]
    sets = _repeated_tokens(near, heavy, n_parts(left)).groupBy("class").agg(F.collect_set("key").alias("keys"))
    shared = sets.join(enough, "class").withColumn("take", F.expr(f"int(size(keys) - (({percent} * n + 99) div 100) + 1)")).where("take > 0")
    prefix = {"prefix1": F.slice(F.sort_array("keys"), 1, F.col("take"))}
    for i in range(2, orders + 1):
        prefix[f"prefix{i}"] = F.slice(F.sort_array(_scrambled(i)), 1, F.col("take"))["k"]
    shared.withColumns({**prefix, "counts": _counters("keys")}).drop("take").write.parquet(f"{root}/active")
    active = spark.read.parquet(f"{root}/active")
    # left: the tokens from this one on, in the first order; tokens of no second class come first.
    placed = active.select(F.posexplode("prefix1").alias("i", "token"), "class", F.col("n").cast("int"), F.expr("int(size(keys) - i)").alias("left"), "counts")
    placed.drop("i").write.parquet(f"{root}/postings0")

    # Rounds.  labels: class -> least class of its component, for merged classes.
    labels, links = None, None
    postings = spark.read.parquet(f"{root}/postings0").withColumn("label", F.col("class"))
    for turn in range(LEADER_ROUNDS + len(PAIR_SHARES)):
        # The first round has the same leaders for all lists of a group, later ones have others for each list.
        member = lambda i: F.struct(F.xxhash64("class", F.lit(turn * LEADERS + i), *(["token"] if turn else [])).alias("o"), F.col("class"), F.col("n"), F.col("left"), F.col("label"), F.col("counts"))  # noqa: B023,E731
        several = postings.groupBy("token").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), *([F.min(member(i)).alias(f"b{i}") for i in range(LEADERS)] if turn < LEADER_ROUNDS else [])
        ).where("lo <> hi")
        if turn < LEADER_ROUNDS:
            members = F.array_distinct(F.array(*[F.struct(*[F.col(f"b{i}.{c}") for c in ("class", "n", "left", "label", "counts")]) for i in range(LEADERS)]))
            leaders = several.select("token", F.explode(members).alias("b")).select("token", "b.*")
            pairs = postings.alias("a").join(leaders.alias("b"), "token").where("a.label <> b.label")
        else:
            mixed = postings.join(several.select("token"), "token", "left_semi")
            # One row per token and component: sizes, places and counters that bound those of its members,
            # so that a set meets only components of which it may be similar to some member.
            most = F.array(*[F.max(F.col("counts")[i]) for i in range(COUNTERS)])
            groups = mixed.groupBy("token", "label").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("left").alias("most"), most.alias("counts"))
            wanted = mixed.alias("a").join(groups.alias("g"), F.col("a.token") == F.col("g.token"))
            wanted = wanted.where(f"a.label < g.label and 100 * a.n >= {percent} * low and 100 * high >= {percent} * a.n")
            wanted = wanted.where(f"{100 + percent} * least(a.left, most) >= {percent} * (a.n + low)")
            wanted = wanted.where(f"{100 + percent} * {_most_common('a', 'g', 'high')} >= {percent} * (a.n + low)")
            wanted = wanted.select("a.*", F.col("g.label").alias("other"))
            pairs = wanted.alias("a").join(mixed.alias("b"), (F.col("a.token") == F.col("b.token")) & (F.col("a.other") == F.col("b.label")))
            share = F.pmod(F.xxhash64("a.class").bitwiseXOR(F.xxhash64("b.class")), F.lit(16))
            low, high = PAIR_SHARES[turn - LEADER_ROUNDS]
            pairs = pairs.where((share >= low) & (share < high))
        pairs = pairs.where(f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)")
        pairs = pairs.where(f"{100 + percent} * least(a.left, b.left) >= {percent} * (a.n + b.n)")
        # Tokens that no second class has are not counted, and not shared.
        pairs = pairs.where(f"{100 + percent} * {_most_common('a', 'b')} >= {percent} * (a.n + b.n)")
        pairs = pairs.select(F.least("a.class", "b.class").alias("a"), F.greatest("a.class", "b.class").alias("b")).distinct()
        _verified(pairs, active, percent, orders).write.parquet(f"{root}/links{turn}")
        new = spark.read.parquet(f"{root}/links{turn}")
        if not new.take(1):
            continue
        links = new if links is None else links.union(new)
        labels = connected_components(spark, links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if turn < LEADER_ROUNDS + len(PAIR_SHARES) - 1:
            merged = spark.read.parquet(f"{root}/postings0").join(labels, F.col("class") == F.col("node"), "left")
            merged.select("token", "class", "n", "left", "counts", F.coalesce("root", "class").alias("label")).write.parquet(f"{root}/postings{turn + 1}")
            postings = spark.read.parquet(f"{root}/postings{turn + 1}")

    least = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    if labels is None:
        of_class = least.select("class", F.col("class").alias("root"), F.col("least").alias("component_id"))
    else:
        of_root = least.join(labels, F.col("class") == F.col("node"), "left").select("class", F.coalesce("root", "class").alias("root"), "least")
        ids = of_root.groupBy("root").agg(F.min("least").alias("component_id"))
        of_class = of_root.join(ids, "root").select("class", "root", "component_id")
    return rows.join(of_class, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *(["text_hash", F.col("root").alias("component")] if row_keys else []),
    )


__all__ = ["connected_components", "jaccard_components"]
