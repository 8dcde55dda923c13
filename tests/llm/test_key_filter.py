from __future__ import annotations

import random

import corpus_pipeline as P
import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import jaccard as J
from daymark.llm import key_filter as K
from daymark.session import shared_dir


def _held(spark, keys):
    path = shared_dir(spark, "test-held")
    K.key_filter(keys).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("most", [1024, 1])
def test_no_row_with_a_key_is_left_out(spark, monkeypatch, most):
    """With too few chunks more rows may have a key; those that have one always do."""
    monkeypatch.setattr(K, "MAX_CHUNKS", most)
    held = _held(spark, spark.range(0, 60_000, 3).select(F.xxhash64("id").alias("key")))
    assert held.count() == min(most, 8)
    rows = spark.range(30_000).union(spark.createDataFrame([(None,)], "id long"))
    may, others = K.split(rows, F.when(F.col("id").isNotNull(), F.xxhash64("id")), held)
    may, others = {r.id for r in may.collect()}, {r.id for r in others.collect()}
    assert may | others == {None, *range(30_000)} and not may & others
    assert set(range(0, 30_000, 3)) <= may and None in others
    assert len(may) < 11_000 or most == 1


def test_no_key_at_all(spark):
    held = _held(spark, spark.range(0).select("id"))
    may, others = K.split(spark.range(50), F.col("id"), held)
    assert may.count() == 0 and others.count() == 50


@pytest.mark.parametrize("percent", [50, 80, 99])
def test_linked_sets_share_as_many_first_tokens_as_the_screen_asks(percent):
    rng = random.Random(percent)
    for _ in range(300):
        n = rng.choice([1, 2, 5, 17, 60, 300])
        a = set(rng.sample(range(10**6), n))
        b = set(a)
        while len(a & b) * 100 >= percent * len(a | b):
            size = np.array([len(a), len(b)])
            first = size - J._least(size, percent) + J._screened(size, percent)
            assert (first <= size).all()
            both = len(set(sorted(a)[: first[0]]) & set(sorted(b)[: first[1]]))
            assert both >= J._screened(J._least(size, percent), percent).max()
            out, new = rng.random() < 0.7, rng.random() < 0.7
            if out and len(b) > 1:
                b.remove(min(b) if rng.random() < 0.5 else rng.choice(sorted(b)))
            if new or not out:
                b.add(rng.randrange(-(10**6), 10**6))


def test_enough_is_the_screen_of_the_least_partner(spark):
    n = np.arange(1, 3000)
    need = J._screened(J._least(n, 80), 80)
    rows = spark.createDataFrame([(int(a), int(b)) for a, b in zip(n, need)], "n long, need long").withColumn("less", F.expr("need - 1"))
    assert rows.where(J._enough("n", "need", 80) & ~J._enough("n", "less", 80)).count() == len(n)


def test_rows_without_near_copies_stay_where_they_are(spark):
    """Texts that no mark can meet are not exchanged."""
    rng = random.Random(8)
    text = lambda: " ".join(str(rng.randrange(10**9)) for _ in range(30))
    texts = [text() for _ in range(300)]
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate([*texts, *texts[:20]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    path = shared_dir(spark, "test-docs")
    docs.write.parquet(path)
    kept = P.keep_one_of_near_copies(spark, spark.read.parquet(path), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    plan = kept._jdf.queryExecution().optimizedPlan()
    assert plan.getClass().getSimpleName() == "Union"
    unmoved = plan.children().head().toString()
    assert "LeftAnti" in unmoved and "strategy=broadcast" in unmoved and unmoved.count("Join") == 1
