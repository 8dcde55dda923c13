"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are dealt to inverted lists by their nearest centroid.  Within a
probed list, vectors are rotated by one random orthogonal matrix and scanned
in blocks of columns: after d of D columns the partial squared distance, scaled
by D/d, estimates the whole one, and a candidate is abandoned when a hypothesis
test says that it lies beyond the query's threshold, a distance within which
enough rows of the sample are known to lie.  Candidates that last through all columns
get their exact cosine from the original vectors.  A query that has found too few
probes further lists, twice as many each time.

Centroids, rotation, thresholds and the number of lists to probe are fitted on a
bounded sample, a small part of the table; every row is indexed, and results come from
the lists alone.  A list is dealt in blocks of rows, and in as many blocks of
queries as those that probe it need: neither a crowded list nor many queries meet in one
task, and a list's rows are copied for its own queries only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.session import shared_dir

#: Rows to fit on: a SAMPLE_PART-th of the table, within these bounds.
SAMPLE_PART = 20
MIN_SAMPLE = 256
SAMPLE_ROWS = 20_000
BLOCK_ROWS = 4096
BLOCK_QUERIES = 8192
COLUMNS = 16
CONFIDENCE = 2.6  # standard errors that a partial distance may lie above its estimate


@dataclass(frozen=True)
class ListIndex:
    centroids: np.ndarray
    rotation: np.ndarray
    probes: int
    sample_ids: np.ndarray
    sample: np.ndarray  # original vectors


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large or small components neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec): vectors as bytes of doubles.  Null, empty and zero vectors and
    those with null or non-finite components are left out, and rows without id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            off = lists.offsets.to_numpy()
            good = np.isfinite(values)
            bad = np.concatenate([[0], np.cumsum(~good)])
            some = np.concatenate([[0], np.cumsum(good & (values != 0))])
            a, b = off[:-1], off[1:]
            keep = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (bad[a] == bad[b]) & (some[b] > some[a]))
            vecs = pa.array([values[a[i] : b[i]].tobytes() for i in keep], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), vecs], ["vec_id", "vec"])

    plain = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return plain.mapInArrow(run, "vec_id long, vec binary")


def _matrix(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def _best_ids(cosine: np.ndarray, order: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Columns of the best rows of each query's k best distinct ids, best first.

    ``order`` sorts the columns by id, the rows of an id begin at ``starts``.
    """
    by_id = cosine[:, order]
    top = np.argsort(-np.maximum.reduceat(by_id, starts, axis=1), axis=1)[:, :k]
    ends = np.append(starts[1:], len(order))
    place = starts[top]
    for r, i in zip(*np.nonzero(ends[top] - place > 1)):
        place[r, i] += by_id[r, place[r, i] : ends[top[r, i]]].argmax()
    return order[place]


def _by_id(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    return order, np.unique(ids[order], return_index=True)[1]


def fit_lists(vectors: DataFrame, n_rows: int, k: int, *, recall: float = 0.985, seed: int = 11) -> ListIndex | None:
    """Fit on the rows with the smallest id hashes, a twentieth of the table (256 rows at
    least, 20,000 at most).

    Vectors of the sample's commonest length count.  ``probes`` is the smallest
    number of lists that holds ``recall`` of the k nearest ids, as measured
    for 200 of the sample's rows against the whole sample by brute force.
    """
    size = min(SAMPLE_ROWS, max(MIN_SAMPLE, n_rows // SAMPLE_PART))
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(size).collect()
    if not drawn:
        return None
    lengths, counts = np.unique([len(r["vec"]) for r in drawn], return_counts=True)
    drawn = [r for r in drawn if len(r["vec"]) == lengths[counts.argmax()]]
    ids, sample = np.array([r["vec_id"] for r in drawn]), _matrix([r["vec"] for r in drawn])
    x = _unit(sample)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    n_lists = max(1, min(int(np.sqrt(n_rows)), len(x) // 8))
    centroids = x[rng.permutation(len(x))[:n_lists]].copy()
    for _ in range(8):
        near = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        full = np.abs(sums).max(axis=1) > 1e-12
        centroids[full] = _unit(sums[full])
    near = (x @ centroids.T).argmax(axis=1)
    some = rng.permutation(len(x))[:200]
    cosine = x[some] @ x.T
    cosine[ids[some][:, None] == ids] = -np.inf
    best = _best_ids(cosine, *_by_id(ids), k)
    rank = np.argsort(np.argsort(-(x[some] @ centroids.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, near[best], axis=1)[np.isfinite(np.take_along_axis(cosine, best, axis=1))])
    probes = 1 + int(needed[int(np.ceil(recall * (len(needed) - 1)))]) if len(needed) else n_lists
    return ListIndex(centroids, rotation, probes, ids, sample)


def _scan(index: ListIndex, ids: np.ndarray, rows: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, limit: np.ndarray, k: int) -> pd.DataFrame:
    """The k best ids of a block for each query that lie within its threshold."""
    dim = rows.shape[1]
    c, q = _unit(rows) @ index.rotation, _unit(queries) @ index.rotation
    norm_c, norm_q = np.sqrt((rows * rows).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    out = []
    for lo in range(0, len(q), 64):
        part = slice(lo, lo + 64)
        first = min(COLUMNS, dim)
        a, b = q[part, :first], c[:, :first]
        partial = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
        far = lambda d, at: limit[at] * (d / dim) * (1 + CONFIDENCE / np.sqrt(d)) ** 2 * (1 + 1e-9) + 1e-9
        bound = far(first, part) if first < dim else limit[part] * (1 + 1e-9) + 1e-9
        i, j = np.nonzero((partial <= bound[:, None]) & (q_ids[part, None] != ids))
        left = partial[i, j]
        for d in range(first, dim, COLUMNS):
            stop = min(d + COLUMNS, dim)
            gap = q[lo + i, d:stop] - c[j, d:stop]
            left = left + (gap * gap).sum(axis=1)
            bound = far(stop, lo + i) if stop < dim else limit[lo + i] * (1 + 1e-9) + 1e-9
            stay = left <= bound
            i, j, left = i[stay], j[stay], left[stay]
        i = i + lo
        score = (queries[i] * rows[j]).sum(axis=1) / (norm_q[i] * norm_c[j])
        # Rows that share an id are one candidate, by the best of them.
        order = np.lexsort((-score, ids[j], i))
        i, j, score = i[order], j[order], score[order]
        fresh = np.ones(len(i), dtype=bool)
        fresh[1:] = (i[1:] != i[:-1]) | (ids[j[1:]] != ids[j[:-1]])
        i, j, score = i[fresh], j[fresh], score[fresh]
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        best = place < k
        out.append(pd.DataFrame({"query_id": q_ids[i[best]], "vec_id": ids[j[best]], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def nearest(rows: DataFrame, is_query: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows by cosine.

    Rows for which ``is_query`` holds (a condition on ``vec_id``) are searched
    for; candidates are all rows but those of the query's own id.  Scores are
    cosines of the original vectors in double precision; ties go to the smaller
    id.  Vectors null, empty, zero, with null or non-finite components or of an
    unusual length take no part; rows that share an id are one candidate, by
    the best of them; an empty
    table gives an empty result.  Other columns, also ones named like the results, are not
    looked at.
    """
    spark = rows.sparkSession
    root = shared_dir(spark, "neighbours")
    usable_vectors(rows, id_col, vector_col).write.parquet(f"{root}/vectors")
    vectors = spark.read.parquet(f"{root}/vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    index = fit_lists(vectors, vectors.count(), k)
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)  # bounded by the sample
    width = index.sample.shape[1] * 8
    vectors = vectors.where(F.octet_length("vec") == width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch.column(1).to_pylist())) if batch.num_rows else np.zeros((0, width // 8))
            near = (x @ shared.value.centroids.T).argmax(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], ["vec_id", "vec", "list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        unit_sample, norms = _unit(own.sample), np.sqrt((own.sample * own.sample).sum(axis=1))
        order, starts = _by_id(own.sample_ids)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                block = batch.slice(lo, 256)
                ids, vecs = block.column(0).to_numpy(), _matrix(block.column(1).to_pylist())
                x = _unit(vecs)
                cosine = x @ unit_sample.T
                cosine[ids[:, None] == own.sample_ids] = -np.inf
                limit = np.full(len(x), np.inf)
                near = _best_ids(cosine, order, starts, k)
                score = (vecs[:, None, :] * own.sample[near]).sum(axis=2) / (np.sqrt((vecs * vecs).sum(axis=1))[:, None] * norms[near])
                real = np.isfinite(np.take_along_axis(cosine, near, axis=1))
                # k ids are known to lie within the distance of the sample's k-th best.
                if near.shape[1] == k:
                    limit = np.where(real.all(axis=1), 2 - 2 * score.min(axis=1), np.inf)
                lists = np.argsort(-(x @ own.centroids.T), axis=1, kind="stable").astype(np.int32)
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(limit), pa.array(list(lists), pa.list_(pa.int32()))], ["vec_id", "vec", "limit", "lists"])

    vectors.mapInArrow(assign, "vec_id long, vec binary, list int").write.parquet(f"{root}/index")
    indexed = spark.read.parquet(f"{root}/index")
    # All lists of each query, nearest centroid first: a row has one number per list.
    vectors.where(is_query).mapInArrow(probe, "vec_id long, vec binary, limit double, lists array<int>").write.parquet(f"{root}/queries")
    queries = spark.read.parquet(f"{root}/queries")

    def scan(right: pd.DataFrame, left: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _scan(shared.value, right["vec_id"].to_numpy(), _matrix(list(right["vec"])), left["vec_id"].to_numpy(), _matrix(list(left["vec"])), left["limit"].to_numpy(), k)

    def scanned(asking: DataFrame, first: int, stop: int) -> DataFrame:
        """What the lists of these ranks hold for the queries."""
        probed = asking.select("vec_id", "vec", "limit", F.explode(F.slice("lists", first + 1, stop - first)).alias("list"))
        # One row per list that is probed: the blocks of rows and of queries it is dealt in.
        counts = probed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
        sizes = F.broadcast(indexed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("salts")).join(counts, "list"))
        probed = probed.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        probed = probed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        dealt = indexed.join(sizes, "list").withColumn("salt", F.pmod(F.xxhash64("vec_id", "vec"), F.col("salts")).cast("int"))
        dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        keys = ["list", "salt", "block"]
        pairs = dealt.select(*keys, "vec_id", "vec").groupBy(*keys).cogroup(probed.select(*keys, "vec_id", "vec", "limit").groupBy(*keys))
        return pairs.applyInPandas(scan, "query_id long, vec_id long, score double")

    n_lists, done, stop, found, asking = len(index.centroids), 0, index.probes, None, queries
    while done < n_lists:
        scanned(asking, done, min(stop, n_lists)).write.parquet(f"{root}/found{done}")
        new = spark.read.parquet(f"{root}/found{done}")
        found = new if found is None else found.union(new)
        full = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
        done, stop = min(stop, n_lists), 2 * stop
        if done < n_lists:
            # The few queries that have fewer than k go on to further lists.
            queries.join(full.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti").write.parquet(f"{root}/asking{done}")
            asking = spark.read.parquet(f"{root}/asking{done}")
            if not asking.take(1):
                break
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


__all__ = ["ListIndex", "fit_lists", "nearest", "usable_vectors"]
