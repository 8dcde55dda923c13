from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import neighbours as N
from tests.llm.test_merkle_and_neighbours import _brute, _found, _frame


def _clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 24))
    x = (centres[rng.integers(0, 6, n)] + 0.7 * rng.normal(size=(n, 24))).astype(np.float32).astype(float)
    return rng.permutation(10 * n)[:n], x


@pytest.mark.parametrize("sample", [1500, 150])
def test_a_table_loaded_twice(spark, monkeypatch, sample):
    monkeypatch.setattr(N, "MIN_SAMPLE", sample)
    ids, x = _clustered(1500)
    queries = [int(i) for i in ids if i % 50 == 0]
    df = _frame(spark, ids, x)
    got = _found(N.nearest(df.union(df).repartition(4), F.col("vec_id") % 50 == 0))
    want = _brute(ids, x, queries, 5)
    assert all(len({v for v, _ in got[q]}) == 5 for q in queries)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in queries)
    assert hits / (5 * len(queries)) >= 0.95


def test_an_id_many_times_near_a_query(spark):
    """Six rows of one id are one candidate, by the best of them."""
    ids, x = _clustered(300, seed=2)
    ids = np.where(ids % 50 == 0, ids + 1, ids)
    near = x[0] + 1e-3 * np.arange(6)[:, None] * x[1]
    all_ids, all_x = np.concatenate([[50], ids, [7777] * 6]), np.concatenate([x[:1] * 1.01 + 0.01 * x[2], x, near + 1e-3])
    got = _found(N.nearest(_frame(spark, all_ids, all_x), F.col("vec_id") == 50))
    stored = all_x.astype(np.float32).astype(float)
    q = stored[0]
    score = (stored @ q) / (np.sqrt((stored * stored).sum(axis=1)) * np.sqrt(q @ q))
    best: dict[int, float] = {}
    for i, s in zip(all_ids[1:].tolist(), score[1:].tolist()):
        best[i] = max(s, best.get(i, -2.0))
    want = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:5]
    assert [v for v, _ in got[50]] == [v for v, _ in want]
    assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got[50], want))


def test_the_sample_is_a_small_part_and_gives_no_results(spark, monkeypatch):
    """Rows beyond the sample are found; queries that find too few probe further lists."""
    ids, x = _clustered(2400, seed=3)
    monkeypatch.setattr(N, "MIN_SAMPLE", 60)
    fitted = []
    fit = N.fit_lists

    def few_probes(*args, **kw):
        index = fit(*args, **kw)
        fitted.append(index)
        return N.ListIndex(index.centroids, index.rotation, 1, index.sample_ids, index.sample)

    monkeypatch.setattr(N, "fit_lists", few_probes)
    queries = [int(i) for i in ids if i % 50 == 0]
    got = _found(N.nearest(_frame(spark, ids, x).repartition(3), F.col("vec_id") % 50 == 0))
    assert len(fitted[0].sample) == 120 and all(len(got[q]) == 5 for q in queries)
    assert len({v for q in queries for v, _ in got[q]} - set(fitted[0].sample_ids.tolist())) > 100
    three = _found(N.nearest(_frame(spark, ids[:4], x[:4]), F.col("vec_id") == int(ids[0])))
    assert [v for v, _ in three[int(ids[0])]] == [v for v, _ in _brute(ids[:4], x[:4], [ids[0]], 5)[int(ids[0])]]
