from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from daymark.llm import catalog
from daymark.llm import spans as S
from daymark.llm.words import utf8
from daymark.session import shared_dir
from tests.llm.conftest import lowered


def _word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))


def _op4(spark, texts, name):
    path = shared_dir(spark, name)
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return {r.doc_id: r for r in catalog.QUERIES["op4_sentence_spans"](spark, path).collect()}


@pytest.mark.parametrize("between", [" ", " | ", "; "])
def test_passages_without_stops_at_different_offsets(spark, between):
    """Against a word-level brute force: only words of repeated 20-word runs go, and most of them do."""
    rng = random.Random(7)
    passages = [[_word(rng) for _ in range(n)] for n in (60, 60, 80, 200)]
    texts = {}
    for i in range(40):
        parts = [_word(rng) for _ in range(rng.randint(0, 40))], passages[i % 4], [_word(rng) for _ in range(rng.randint(0, 40))]
        texts[i] = between.join(w for part in parts for w in part)
    got = _op4(spark, texts, "test-offsets")
    seen = set()
    for i in sorted(texts):
        words = lowered(texts[i])
        runs = [tuple(words[a : a + 20]) for a in range(len(words) - 19)]
        repeated = {words[a + k] for a, run in enumerate(runs) if run in seen for k in range(20)} - {"|"}
        gone = set(words) - set(lowered(got[i].text)) - {"|"}
        assert gone <= repeated
        assert len(gone) >= len(repeated) / 2, (i, len(gone), len(repeated))
        seen |= set(runs)


def test_equal_passages_are_cut_alike():
    rng = random.Random(3)
    passage = [_word(rng) for _ in range(300)]
    inner = []
    for before in (3, 10, 17, 41):
        text = " ".join([_word(rng) for _ in range(before)] + passage + [_word(rng) for _ in range(9)])
        heads, *_ = S.sentences(*utf8(pa.array([text])), local_cuts=True)
        inner.append([h - before for h in heads.tolist() if S.WINDOW <= h - before < 300 - S.WINDOW - 1])
    assert all(x == inner[0] for x in inner) and len(inner[0]) > 20


def test_stops_of_other_scripts_and_behind_quotes():
    text = 'a b." c (d e.) f 漢字。 g هل؟ h i” j 3.5 k'
    heads, at, *_ = S.sentences(*utf8(pa.array([text, '." x', '" ) y'])), local_cuts=True)
    assert heads[: at[1]].tolist() == [0, 2, 5, 7, 9] and np.diff(at).tolist() == [5, 2, 1]


def test_words_that_repeat_are_cut_by_whole_periods():
    for period in (1, 2, 3, 7):
        text = " ".join(["x", "y", "z"] + [f"w{i % period}" for i in range(400)])
        heads, _, _, words = S.sentences(*utf8(pa.array([text])), local_cuts=True)
        sizes = np.diff(heads)[2:-2]
        assert len(set(sizes.tolist())) == 1 and sizes[0] % period == 0 and S.WINDOW < sizes[0] <= S.WINDOW + period


def test_every_sentence_of_a_repeated_passage_goes(spark):
    """The last sentences of a passage start no run of 20 words; against the hashing of all runs."""
    rng = random.Random(5)
    sentence = lambda n: " ".join(_word(rng) for _ in range(n)) + ". "
    passages = [[sentence(n) for n in sizes] for sizes in ([3, 5, 4, 7, 8], [4, 6, 5, 2, 3, 1], [1] * 25, [8, 8, 8, 1, 1, 2])]
    own = [[sentence(rng.randint(1, 8)) for _ in range(4)] for _ in range(12)]
    cut = {i: [*own[i][:2], *passages[i % 4], *own[i][2:]] for i in range(12)} | {20 + i: p for i, p in enumerate(passages)}
    got = _op4(spark, {i: "".join(s) for i, s in cut.items()}, "test-both-sides")
    seen, want = set(), {}
    for i in sorted(cut):
        runs = [(a, b) for a in range(len(cut[i])) for b in range(a + 2, len(cut[i]) + 1) if len(lowered("".join(cut[i][a:b]))) >= 20]
        gone = {k for a, b in runs if "".join(cut[i][a:b]) in seen for k in range(a, b)}
        want[i] = ("".join(s for k, s in enumerate(cut[i]) if k not in gone), len(cut[i]), len(gone))
        seen |= {"".join(cut[i][a:b]) for a, b in runs}
    assert {i: (r.text, r.n_sentences, r.n_removed) for i, r in got.items()} == want
    assert all(got[20 + i].text == "" for i in range(4))


def test_a_repeated_document_goes_whole(spark):
    import corpus_pipeline as P

    rng = random.Random(6)
    text = "".join(" ".join(_word(rng) for _ in range(n)) + ". " for n in (8, 8, 5, 4))
    docs = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, text, "en", "a", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    assert [(r.doc_id, r.text) for r in P.drop_repeated_passages(spark, docs, "").collect()] == [(1, text)]
