from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline as P
from daymark.llm.mix import mix_sources

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _texts(n, seed, words=40):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(words)) for _ in range(n)]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def test_one_row_of_each_component(spark):
    a, b, c, d, e, f = _texts(6, 1)
    near = a + " and"
    rows = [(1, a, "x"), (1, a, "x"), (2, near, "x"), (2, b, "x"), (None, c, "x"), (None, near, "x"), (None, c, "x")]
    rows += [(5, d, "x"), (9, d, "x"), (5, e, "x"), (10, e, "x"), (11, f, "x"), (12, None, "x"), (12, "", "x"), (3, near, "y"), (3, near, "z")]
    got = P.keep_one_of_near_copies(spark, _docs(spark, rows), "").collect()
    want = [(1, a), (2, b), (None, c), (5, d), (5, e), (11, f), (12, None), (12, "")]
    assert Counter((r.doc_id, r.text) for r in got) == Counter(want)


def test_each_row_as_often_as_the_mix_takes_it(spark):
    """Shared ids, null ids and equal rows: all rows of a text together come as often as they are taken."""
    texts = _texts(8, 2)
    rows = [(i % 2 if i % 3 else None, texts[i % 8], "ab"[i % 2]) for i in range(30)] + [(7, texts[0], "b")] * 25 + [(8, texts[1], "a")] * 9
    docs = _docs(spark, rows)
    taken = mix_sources(docs).documents.groupBy("doc_id", "source", "text_hash").sum("copies")
    want = {tuple(r)[:3]: r[3] for r in taken.collect() if r[3]}
    got = P.mix(spark, docs, "").selectExpr("doc_id", "source", "xxhash64(text)").collect()
    assert Counter(tuple(r) for r in got) == want
    counts = Counter((r.doc_id, r.source, r.text_hash, r.copies) for r in mix_sources(docs).documents.collect())
    assert max(Counter(k[:3] for k in counts).values()) > 1  # equal rows that are taken a different number of times
