from __future__ import annotations

import numpy as np

from daymark.llm import jaccard as J


def test_a_block_that_passes_65536_classes():
    """Pieces of 9,999 distinct rows: the block is asked at 59,994 classes and then holds 69,993."""
    block, want = J._Block(), {}
    for piece in range(20):
        if block.full():
            break
        ids = np.arange(piece * 9_999, (piece + 1) * 9_999) + 10**12
        tokens = (ids.astype(np.uint64) * np.uint64(2) + np.uint64(1)) << np.uint64(8)
        block.add(np.sort(np.concatenate([tokens, tokens + np.uint64(256)])), np.arange(0, 2 * len(ids) + 1, 2), ids)
        want |= {int(t) >> 8: int(i) for t, i in zip(tokens, ids)}
    assert len(block.ids) == 69_993
    tokens, local = block.sorted()
    got_tokens, got_ids = J._unpack(J._pack(tokens >> np.uint64(8), local, np.array(block.ids, dtype=np.int64)))
    assert len(got_tokens) == 2 * 69_993
    assert all(want[t - 1 + t % 2] == i for t, i in zip(got_tokens.tolist(), got_ids.tolist()))
    few = local < 100
    assert J._unpack(J._pack(tokens[few] >> np.uint64(8), local[few], np.array(block.ids, dtype=np.int64)))[1].tolist() == got_ids[few].tolist()


def test_token_counters_of_very_long_texts(spark):
    """40,001 keys in one counter: it is full and bounds nothing, other counters still do."""
    sets = spark.range(2).selectExpr(
        "id", "transform(sequence(0L, 40000L), i -> 64 * i) AS full", "transform(sequence(0L, 99L), i -> 64 * i) AS few"
    )
    rows = sets.selectExpr("id", "array_union(full, array(1L + 64 * id)) AS keys", "few").withColumns({"counts": J._counters("keys"), "counts_few": J._counters("few")})
    rows = rows.selectExpr("id", "counts", "size(keys) AS n", "counts_few")
    a, b = rows.where("id = 0").alias("a"), rows.where("id = 1").alias("b")
    assert a.crossJoin(b).selectExpr(J._most_common("a", "b")).first()[0] >= 40_001
    few = rows.where("id = 1").selectExpr("counts_few AS counts", "100 AS n").alias("b")
    assert a.crossJoin(few).selectExpr(J._most_common("a", "b")).first()[0] == 100
