from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from daymark.llm import merkle as M
from daymark.llm import neighbours as N


def test_fingerprints_tell_equal_texts_and_locate_edits(spark):
    body = "First line of words here.\nSecond line has more words in it.\n\nA new section, one line.\nAnd the last one."
    texts = [body, body, body.replace("more", "fewer"), body + " ", body.replace("\n\n", "\n"), "", "unrelated words only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = M.fingerprint_documents(docs).orderBy("doc_id").collect()
    prints = [r.fingerprint for r in rows]
    assert prints[0] == prints[1] and len({p[:32] for p in prints}) == 6
    pairs = spark.createDataFrame([(prints[0], p) for p in prints], "a string, b string")
    got = pairs.select(M.likeness("a", "b").alias("n"), M.changed_paragraphs("a", "b").alias("at")).collect()
    near, at = [r.n for r in got], [r["at"] for r in got]
    assert near[:2] == [1.0, 1.0] and 0.5 < near[2] < 1 and near[5] == near[6] == 0
    assert at[0] == [] and at[2] == [1] and at[3] == [3]
    empty = spark.createDataFrame([(prints[5], prints[5])], "a string, b string").select(M.likeness("a", "b")).first()[0]
    assert empty == 1.0


def _edited(texts):
    out = []
    for i, t in enumerate(texts):
        n = len(t) // 4
        out.append(t[: len(t) - n] + texts[(i + 1) % len(texts)][:n])
    return out


def test_edit_likeness(spark):
    texts = ["a b c d e f g h i j k l m n o p", "", None, "👍👍👍👍 é漢字", "x", "same words in both texts here ok", "same words in both texts here ok", "w " * 5000]
    docs = spark.createDataFrame([(i * 3, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, n string").repartition(4)
    rows = M.edit_likeness(docs).orderBy("doc_id").collect()
    plain = [t or "" for t in texts]
    for r, text, edited in zip(rows, plain, _edited(plain)):
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert rows[1].near_edited == rows[1].near_next == 1.0  # an empty text, then a null one
    assert rows[5].near_next == 1.0 and rows[5].fingerprint == rows[6].fingerprint
    assert rows[0].near_edited > rows[0].near_next == 0
    again = spark.createDataFrame([(r.fingerprint, r.edited_fingerprint, r.near_edited) for r in rows], "a string, b string, n double")
    assert again.where(F.abs(M.likeness("a", "b") - F.col("n")) > 1e-12).count() == 0


def test_edit_likeness_of_repeated_rows_and_small_tables(spark, awkward):
    assert M.edit_likeness(awkward).count() == awkward.count()
    one = M.edit_likeness(awkward.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert M.edit_likeness(awkward.where("doc_id < 0")).count() == 0


def test_only_built_in_functions(spark, awkward):
    plan = M.edit_likeness(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def _brute(ids, x, queries, k):
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        s = (x[i] * x).sum(axis=1) / (norm[i] * norm)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def _frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<float>")


def _found(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    """A small sample and small blocks, so that lists, abandoning and dealing are at work."""
    monkeypatch.setattr(N, "SAMPLE_ROWS", 600)
    monkeypatch.setattr(N, "BLOCK_ROWS", 100)
    monkeypatch.setattr(N, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 40))
    x = (centres[rng.integers(0, 12, 3000)] + 0.7 * rng.normal(size=(3000, 40))).astype(np.float32).astype(float)
    x[500:900] = x[500]  # one vector many times: ties go to the smaller id
    ids = rng.permutation(10_000)[:3000]
    queries = [int(i) for i in ids if i % 50 == 0]
    got = _found(N.nearest(_frame(spark, ids, x).repartition(4), F.col("vec_id") % 50 == 0))
    want = _brute(ids, x, queries, 5)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in queries)
    assert hits / (5 * len(queries)) >= 0.9
    scores = {(q, v): s for q in queries for v, s in _brute(ids, x, [q], 3000)[q]}
    assert all(len(got[q]) == 5 for q in queries)
    assert all(abs(s - scores[q, v]) < 1e-12 for q in queries for v, s in got[q])


def test_odd_vectors_and_small_tables(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (7, []), (8, [float("inf"), 1.0]), (50, [2.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = _found(N.nearest(df, F.col("vec_id") % 50 == 0))
    assert [v for v, _ in got[0]] == [50, 1] and [v for v, _ in got[50]] == [0, 1] and set(got) == {0, 50}
    assert got[0][0][1] == 1.0
    assert N.nearest(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0
    assert N.nearest(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0
