from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import shards as SH
from daymark.llm.mix import mix_sources, word_count
from daymark.llm.running import running_totals
from tests.conftest import SF_SMALL
from tests.llm.conftest import AWKWARD, lowered


def test_word_count(spark, awkward):
    got = [r.n for r in awkward.where("doc_id < 50").orderBy("doc_id").select("text", word_count("text").alias("n")).collect()]
    want = [len(lowered(t)) for t in AWKWARD]
    assert sorted(got) == sorted([*want, want[6], want[6]])


def test_running_totals(spark):
    rows = [(g, i * 7919 % 101, (i * 31) % 5) for g in ("a", "b", None) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(7)
    got = sorted(((r.row_uid, r.g, r.k, r.v, r.total) for r in running_totals(df, ["k"], "v", group="g", out_col="total").collect()))
    sums, last = Counter(), {}
    for _, g, k, v, total in got:
        sums[g] += v
        assert total == sums[g] and last.get(g, -1) <= k
        last[g] = k
    whole = running_totals(df, ["k", "g"], "v", out_col="total").collect()
    assert max(r.total for r in whole) == sum(v for _, _, v in rows)


def test_mix_targets_and_copies(spark, awkward):
    rows = [(i, " ".join(["w"] * (1 + i % 17)), f"s{i % 7}", "x") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").repartition(5)
    mixed = mix_sources(docs)
    got = mixed.documents.collect()
    again = {r.doc_id: r.taken for r in mix_sources(docs.repartition(3)).documents.collect()}
    assert again == {r.doc_id: r.taken for r in got} and len(got) == 700
    taken, target, size = Counter(), {}, {}
    for r in got:
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in target:
        assert target[s] <= 2 * size[s] and abs(taken[s] - target[s]) <= 17
    stream = mixed.stream.orderBy("position").collect()
    assert [r.finish for r in stream] == sorted(r.finish for r in stream)
    assert Counter(r.doc_id for r in stream) == Counter({r.doc_id: r.copies for r in got if r.copies})

    rows = mix_sources(awkward).documents.collect()
    assert len(rows) == awkward.count() and {r.source for r in rows} == {"a", "b", None, ""}
    assert mix_sources(awkward.where("doc_id < 0")).documents.count() == 0


def _check_shards(rows, n, tolerance):
    slots, size = defaultdict(list), Counter({s: 0 for s in range(n)})
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
        assert r.size == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(n))
    share = sum(size.values()) / n
    assert max(abs(v - share) for v in size.values()) <= share * tolerance + max(r.size for r in rows)


def test_shards(spark, awkward):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = SH.shard_documents(docs.repartition(7)).collect()
    _check_shards(rows, 8, 0.01)
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in SH.shard_documents(docs.repartition(3)).collect()}
    together = defaultdict(set)
    for r in rows:
        together[r.text].add(r.shard)
    assert sum(len(s) > 1 for s in together.values()) <= 7  # a group may be divided where a splitter falls
    # One text holds half of all bytes; shards are exchanged in several parts.
    hot = spark.range(3000).selectExpr("id AS doc_id", "if(id % 2 = 0, repeat('hot ', 20), repeat(cast(id AS string), 20)) AS text")
    _check_shards(SH.shard_documents(hot, 4, part_bytes=20_000).collect(), 4, 0.01)
    got = SH.shard_documents(awkward, 3).collect()
    assert len(got) == awkward.count() and {r.lang for r in got} == {"en", None}
    assert SH.shard_documents(awkward.where("doc_id < 0")).count() == 0


def test_splitters_meet_the_tolerance(spark):
    rng = np.random.default_rng(0)
    keys = rng.integers(-(2**62), 2**62, 5000)
    rows = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, rng.integers(1, 50, 5000))], "sort_key long, size long")
    total = rows.agg(F.sum("size")).first()[0]
    found = SH.find_splitters(rows, [total / 3, 2 * total / 3], [60.0, 60.0])
    for k, t in zip(found, (total / 3, 2 * total / 3)):
        assert abs(rows.where(F.col("sort_key") < k).agg(F.sum("size")).first()[0] - t) <= 60


def test_probes_of_a_turn_are_bounded_and_shards_equal_a_sorted_list(spark, monkeypatch):
    """Many parts, few probes a turn; shards, slots and order are those of the sorted rows."""
    monkeypatch.setattr(SH, "MAX_PROBES", 64)
    monkeypatch.setattr(SH, "FIRST_PROBES", 16)
    asked = []
    count = SH._bytes_between
    monkeypatch.setattr(SH, "_bytes_between", lambda rows, probes: asked.append(len(probes)) or count(rows, probes))
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i} " * (1 + i % 40)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = SH.shard_documents(docs, 4, part_bytes=4000).withColumn("k", SH.sort_key("text", "doc_id")).collect()
    n_parts = 4 * -(-sum(r.size for r in got) // 16000)
    assert n_parts > 20 and max(asked) <= max(64, 3 * n_parts)
    ordered = sorted(got, key=lambda r: (r.k, r.doc_id))
    assert [(r.shard, r.slot) for r in ordered] == sorted((r.shard, r.slot) for r in got)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * (0.001 * sum(sizes.values()) + max(r.size for r in got))
