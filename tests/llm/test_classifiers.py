from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daymark.llm import quality as Q
from daymark.llm import toxicity as X
from daymark.llm.labelled import in_fold, labelled_sample


def _words(rng, n):
    return [rng.choice("ba be bi bo du da ko ke ki mo ma su sa ti ta".split()) + rng.choice("lor nar mil gan vet".split()) for _ in range(n)]


def _auc(score, label):
    place = np.empty(len(score))
    place[np.argsort(score, kind="stable")] = np.arange(len(score))
    pos = label.sum()
    return (place[label == 1].sum() - pos * (pos - 1) / 2) / (pos * (len(label) - pos))


def test_fold():
    assert X.fold("Ⅰdіоt 1D10T, sсum! ｔrash m​oron ÍDIÓT") == " idiot idiot scum trash moron idiot "
    assert X.fold("cafe 2024 a-b") == X.fold("CAFÉ 2024 a b")
    assert X.fold("") == " "


def test_toxicity_learns_words_stems_and_disguises(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        words = _words(rng, rng.randint(20, 80))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vermin", "halfwit", "grobian" + rng.choice(["o", "us", "ka"])]))
        elif i % 3 == 0:
            words[4:4] = ["vermin", "control"]
        rows.append((i, " ".join(words), int(toxic)))
    train = spark.createDataFrame([(t, y) for i, t, y in rows if i < 600], "text string, label int")
    model = X.fit_toxicity(train)
    entries = {e for e, _ in model.entries}
    assert " haifwit " in entries and any(e.startswith(" grobian") for e in entries)
    assert " vermin controi " in model.exceptions
    test = rows[600:] + [(2000, "malor h4lfwіt ganda groB1anus tilor", 1), (2001, "malor vermin control ganda", 0), (2002, None, 0), (2003, "", 0)]
    scored = X.score_toxicity(spark.createDataFrame(test, "doc_id long, text string, score int").repartition(3), model).collect()
    by_id = {r.doc_id: r.score for r in scored}
    assert len(scored) == len(test) and all(0 <= s <= 1 for s in by_id.values())
    wrong = [i for i, _, y in test if (by_id[i] >= 0.3) != bool(y)]
    assert not wrong
    assert X.score_toxicity(train.limit(0), model).count() == 0
    # The same sample gives the same model; one class only gives its share.
    assert X.fit_toxicity(train.repartition(5)) == model
    flat = X.fit_toxicity(train.where("label = 0"))
    assert flat.entries == () and X.Matcher(flat).score("halfwit") < 0.1


def test_score_is_normalised_by_length():
    matcher = X.Matcher(X.ToxicityModel(((" vermin ", 2.0),), (), -3.0))
    short, long_ = "vermin " + "ok " * 10, "vermin " + "ok " * 1000
    assert matcher.score(short) > matcher.score(long_) > matcher.score("ok " * 10)
    assert matcher.score(None) == matcher.score("") == matcher.score("ok")


def test_factorisation_machine_uses_pairs(spark):
    """Neither word tells the class, only both or neither."""
    rng = random.Random(6)
    rows = []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = _words(rng, 6) + ["alpha"] * (3 * a) + ["omega"] * (3 * b) + ["filler"] * (6 - 3 * a - 3 * b)
        rows.append((" ".join(rng.sample(words, len(words))), int(a == b)))
    sample = spark.createDataFrame(rows[:900], "text string, label int")
    model = Q.fit_quality(sample, epochs=40)
    score = model.score(pa.array([t for t, _ in rows[900:]]))
    assert _auc(score, np.array([y for _, y in rows[900:]])) > 0.9
    again = Q.fit_quality(sample.repartition(4), epochs=40)
    assert np.allclose(again.factors, model.factors)


def test_linear_time_sum_equals_all_pairs():
    rng = np.random.default_rng(3)
    n_stats, split = len(Q._CLASSES) + 12, 1 << Q.BUCKET_BITS
    model = Q.FactorisationMachine(0.3, rng.normal(size=split + n_stats), rng.normal(size=(split + n_stats, Q.FACTORS)), np.zeros(n_stats), np.ones(n_stats))
    stats, buckets, at = Q.features(pa.array(["some words some", "", "x"]))
    got = model._sums(stats, buckets, at)[0]
    for row in range(3):
        own = buckets[at[row] : at[row + 1]]
        items = [(int(b), 1 / np.sqrt(len(own))) for b in own] + [(split + i, float(np.clip(v, -5, 5))) for i, v in enumerate(stats[row])]
        want = 0.3 + sum(model.weights[i] * x for i, x in items)
        for n, (i, x) in enumerate(items):
            want += sum(x * y * (model.factors[i] @ model.factors[j]) for j, y in items[n + 1 :])
        assert np.isclose(got[row], want)


def test_quality_on_awkward_documents(spark, awkward):
    sample = spark.createDataFrame([("good words here.", 1), ("bad ### ###", 0), ("more good words.", 1), ("### $$$", 0)], "text string, label int")
    model = Q.fit_quality(sample)
    rows = Q.score_quality(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    one = Q.fit_quality(sample.where("label = 1"))
    assert (one.score(pa.array(["x", "### y"])) > 0.5).all()
    assert np.isfinite(Q.fit_quality(sample.limit(0)).score(pa.array(["x", None]))).all()
    assert Q.score_quality(awkward.where("doc_id < 0"), model).count() == 0


def test_folds_and_sample(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id"))
    got = {r.doc_id: r.f for r in ids.select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}
    docs = ids.selectExpr("doc_id", "if(doc_id = 3, null, 'x') AS text")
    labels = ids.selectExpr("doc_id", "case when doc_id % 4 = 0 then 1 when doc_id % 9 = 1 then null else 0 end AS toxic")
    sample = labelled_sample(docs, labels, "toxic", F.col("doc_id") > 1, 30).collect()
    assert [sum(r.label == y for r in sample) for y in (0, 1)] == [30, 30]
