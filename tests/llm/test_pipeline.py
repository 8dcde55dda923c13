from __future__ import annotations

from collections import Counter

import corpus_pipeline as P
from daymark.llm import catalog
from daymark.session import shared_dir
from tests.conftest import SF_SMALL


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in P.STAGES:
        path = shared_dir(spark, "test-pipeline", name)
        stage(spark, seen[-1], SF_SMALL).write.parquet(path)
        seen.append(spark.read.parquet(path))
    assert [d.columns for d in seen[:-1]] == [columns] * 5 and seen[-1].columns == [*columns, "piece_ids"]
    assert [d.dtypes for d in seen[:-1]] == [docs.dtypes] * 5
    ids = [Counter(r.doc_id for r in d.select("doc_id").collect()) for d in seen]
    assert set(ids[1]) <= set(ids[0]) and len(ids[1]) < len(ids[0])
    apart = catalog.QUERIES["op3_jaccard_join"](spark, SF_SMALL).collect()
    assert all(sum(r.doc_id in ids[2] for r in apart if r.component_id == c) <= 1 for c in {r.component_id for r in apart})
    assert set(ids[3]) <= set(ids[2]) and max(ids[4].values()) <= 2
    texts = {r.doc_id: r for r in seen[3].collect()}
    assert all(r.n_chars == len(r.text) for r in texts.values())
    assert ids[5] == ids[4]
    assert all(r.text == texts[r.doc_id].text for r in seen[5].collect())


def test_names_and_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_copies", "repeated_passages", "mix", "sentencepiece"]
    assert sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES) == list(range(1, 14))
