from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daymark.llm import catalog
from daymark.llm import language as L
from daymark.llm.labelled import in_fold
from tests.llm.conftest import AWKWARD

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return L.fit_language(L.language_sample(docs, ~in_fold(F.col("doc_id"), 4, 2), max_rows=80))


def test_words():
    texts = ["L'Été d’une  x_1 «là» ºª", None, "", "12 !?", "Straße漢字 ü", "a" * 70 + "b", "…é", "é"]
    raw, start, end, at = L.words_of(pa.array(texts))
    got = [[bytes(raw[a:b]).decode() for a, b in zip(start[i:j], end[i:j])] for i, j in zip(at[:-1], at[1:])]
    want = [re.findall(r"[a-zªµºÀ-῿⁀-\U0010ffff]+", (t or "").lower()) for t in texts]
    assert got == want and got[0] == ["l", "été", "d", "une", "x", "là", "ºª"]


def test_features_do_not_depend_on_neighbours():
    def of(texts):
        raw, start, end, _ = L.words_of(pa.array(texts))
        f = L.features(raw, start, end)
        return [(f.keys[i], f.affix[i].tolist(), f.gram[f.gram_at[i] : f.gram_at[i + 1]].tolist()) for i in range(len(start))]

    words = ["ab", "c", "straße", "x" * 200, "x" * 199 + "y", "ab"]
    together = of([" ".join(words), "z"])
    assert together[:-1] == [of([w])[0] for w in words]
    assert together[0] == together[5] and len({str(x) for x in together}) == 6


def brute(scores: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Marginals by the sum over all label sequences."""
    n, k = scores.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        value = start[path[0]] + sum(scores[i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
        for i, y in enumerate(path):
            out[i, y] += np.exp(value)
    return out / out.sum(axis=1, keepdims=True)


def test_forward_backward_equals_all_paths(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(L, "BLOCK", 3)
    for k in (2, 3):
        sizes = [0, 1, 7, 3, 0, 4, 6, 2]
        at = np.concatenate([[0], np.cumsum(sizes)])
        scores, start, move = rng.normal(0, 2, (at[-1], k)), rng.normal(size=k), rng.normal(0, 2, (k, k))
        got = L._marginals(scores, at, start, move)
        parts = [brute(scores[a:b], start, move) for a, b in zip(at[:-1], at[1:]) if b > a]
        np.testing.assert_allclose(got, np.concatenate(parts), atol=1e-12)
        filled = np.concatenate([[0], np.cumsum([s for s in sizes if s])])
        p, pair, first = L._expected(scores, filled, start, move)
        np.testing.assert_allclose(p, got, atol=1e-12)
        assert pair.sum() == pytest.approx(sum(s - 1 for s in sizes if s)) and first.sum() == pytest.approx(6)


def test_gradient_of_the_fit():
    """Expected minus told transitions is the slope of the log-likelihood."""
    rng = np.random.default_rng(6)
    scores, start, move = rng.normal(size=(5, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    path = [0, 1, 1, 0, 0]

    def loss(move):
        value = lambda p: start[p[0]] + sum(scores[i, y] for i, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))
        return np.log(sum(np.exp(value(p)) for p in itertools.product(range(2), repeat=5))) - value(path)

    told = np.zeros((2, 2))
    for a, b in zip(path, path[1:]):
        told[a, b] += 1
    slope = L._expected(scores, np.array([0, 5]), start, move)[1] - told
    for a, b in itertools.product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-6
        assert (loss(move + step) - loss(move - step)) / 2e-6 == pytest.approx(slope[a, b], abs=1e-6)


def test_held_out_languages(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(in_fold(F.col("doc_id"), 4, 2))
    rows = L.label_documents(docs, model).collect()
    assert len(rows) > 200 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.985
    assert all(0 <= r.score <= 1 for r in rows) and np.mean([r.score for r in rows]) > 0.95


def test_code_switched_texts(spark, model):
    """Spliced held-out texts: words are labelled by the part they come from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(in_fold(F.col("doc_id"), 4, 2) & (F.length("text") > 400)).orderBy("doc_id").collect()
    by = {lang: [r.text for r in docs if r.lang == lang] for lang in model.languages}
    right = total = 0
    for i in range(40):
        a, b = model.languages[i % 4], model.languages[(i + 1 + i // 4) % 4]
        if a == b:
            continue
        parts = [(x, " ".join(by[x][(i + j) % len(by[x])].split()[:25])) for j, x in enumerate((a, b, a))]
        text = " ".join(p for _, p in parts)
        want = [x for x, p in parts for _ in range(len(L.words_of(pa.array([p]))[1]))]
        _, _, runs = L.label_texts(pa.array([text]), model)
        got = [r["lang"] for r in runs[0] for _ in range(r["words"])]
        assert [r["first_word"] for r in runs[0]] == list(np.cumsum([0] + [r["words"] for r in runs[0]])[:-1])
        assert len(got) == len(want)
        right += sum(g == w for g, w in zip(got, want))
        total += len(want)
    assert right / total > 0.9


def test_awkward_texts(spark, awkward, model):
    rows = L.label_documents(awkward.withColumn("lang_pred", F.lit(1)), model, runs_col="runs").collect()
    assert len(rows) == awkward.count()
    for r in rows:
        und = r.text is None or not re.search(r"[^\W\d_]", r.text)
        assert (r.lang_pred == "und") is und and (r.score == 0) is und and (r.runs == []) is und
        assert und or r.lang_pred in model.languages
    twice = [(r.lang_pred, r.score) for r in rows if r.text == AWKWARD[6]]
    assert len(twice) == 3 and len(set(twice)) == 1
    assert L.label_documents(awkward.where("doc_id < 0"), model).count() == 0


def test_long_text_is_read_whole(model):
    german = "und die der ist nicht ein auf von zu mit schach " * 3000
    english = "the and of with that was this from have which " * 30000
    names, score, runs = L.label_texts(pa.array([german + english]), model)
    assert names == ["en"] and 0.85 < score[0] < 0.95 and [r["lang"] for r in runs[0]] == ["de", "en"]


def test_sample_and_fit_without_or_with_one_language(spark):
    docs = spark.createDataFrame(
        [(1, "uno dos", "es"), (1, "uno", "es"), (2, "one two", "en"), (2, "x", "fr"), (3, None, "en"), (4, "four", None), (5, "y" * 50, "en")]
        + [(10 + i, f"w{i}", "zz") for i in range(9)],
        "doc_id long, text string, lang string",
    )
    rows = L.language_sample(docs, F.lit(True), max_rows=3, max_chars=40).collect()
    assert sorted((r.lang, r.text) for r in rows if r.lang != "zz") == [("en", "one two"), ("es", "uno")]
    assert len([r for r in rows if r.lang == "zz"]) == 3
    assert {r.lang for r in L.language_sample(docs, F.lit(True), max_languages=1).collect()} == {"zz"}
    for sample, want in ((docs.where("doc_id < 0"), ["und", "und"]), (docs.where("doc_id = 1"), ["es", "und"])):
        names, score, _ = L.label_texts(pa.array(["anything", "12"]), L.fit_language(sample.select("text", "lang")))
        assert names == want and score[1] == 0


def test_query(spark):
    rows = catalog.QUERIES["op12_language"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 0.2 < len(held) / len(rows) < 0.3
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.985
