from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import catalog
from daymark.llm import toxicity as X
from daymark.llm.labelled import labelled_sample

SF = "/root/testdata/sf0.1"


def test_a_repeated_id_is_sampled_once_and_its_labels_follow_a_rule(spark):
    docs = spark.createDataFrame([(1, f"t{i % 7}") for i in range(500)] + [(2, "two"), (3, None), (4, "four")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (2, 0), (3, 0), (4, None), (5, 1), (6, 2)], "doc_id long, toxic int")
    for parts in (1, 5):
        rows = labelled_sample(docs.repartition(parts), labels.repartition(parts), "toxic", F.lit(True), 10).collect()
        assert sorted((r.text, r.label) for r in rows) == [("", 0), ("t0", 1), ("two", 0)]
    assert labelled_sample(docs, labels, "toxic", F.lit(True), 1).count() == 2


def auc(rows, truth) -> float:
    ranked = sorted((r.score, truth[r.doc_id]) for r in rows)
    place = np.arange(1, len(ranked) + 1)
    label = np.array([y for _, y in ranked])
    pos = label.sum()
    return (place[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos))


@pytest.mark.parametrize(("query", "label", "least"), [("op2_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.95)])
def test_held_out_labels(spark, query, label, least):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r[label] is not None}
    rows = [r for r in catalog.QUERIES[query](spark, SF).where("held_out").collect() if r.doc_id in truth]
    assert len(rows) > 300 and auc(rows, truth) > least
    if label == "toxic":
        told = Counter((truth[r.doc_id], r.predicted) for r in rows)
        assert told[1, 1] / (told[1, 0] + told[1, 1]) > 0.9 and told[0, 1] / (told[0, 0] + told[0, 1]) < 0.01


def naive(model: X.ToxicityModel, text: str | None) -> float:
    """Every word tried against every entry; the longest counts, unless an exception covers the word's start."""
    folded = X.fold(text or "") if text else ""
    starts = [i for i in range(len(folded) - 1) if folded[i] == " "]
    covered = set()
    for phrase in model.exceptions:
        at = folded.find(phrase)
        while at >= 0:
            covered |= set(range(at, at + len(phrase) - 1))
            at = folded.find(phrase, at + 1)
    counts: Counter = Counter()
    for s in starts:
        fits = [i for i, (e, _) in enumerate(model.entries) if folded.startswith(e, s)]
        if fits and s not in covered:
            counts[max(fits, key=lambda i: len(model.entries[i][0]))] += 1
    n = folded.count(" ") - 1 if folded else 0
    z = model.bias + sum(model.entries[i][1] * math.sqrt(100 * c / max(n, 1)) for i, c in counts.items())
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def test_automaton_equals_a_naive_matcher(spark):
    entries = ((" idiot ", 2.0), (" idio", 1.0), (" trash", 1.5), (" trashtalk ", 0.5), (" du", 0.25))
    model = X.ToxicityModel(tuple((X.fold(e.strip())[: len(e)] if e.endswith(" ") else " " + X.fold(e.strip()).strip(), w) for e, w in entries), (" trash can ",), -1.5)
    rng = np.random.default_rng(2)
    words = ["idiot", "1d10t", "IDIOTIC", "trash", "trashtalk", "can", "dumb", "du", "ok", "trаsh", "x", "idio"]
    texts = [" ".join(rng.choice(words, n)) + end for n, end in zip(rng.integers(0, 40, 300), ["", "!", " ."] * 100)] + [None, "", "trash can trash can", "idiot" * 40_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in X.score_toxicity(docs, model).collect():
        assert r.score == pytest.approx(naive(model, r.text), abs=1e-12), r.text
