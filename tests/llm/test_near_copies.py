from __future__ import annotations

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daymark.llm import jaccard as J
from daymark.llm import spans as S
from daymark.llm.words import pieces, shingle_sets
from tests.llm.conftest import lowered


def _set(text):
    w = lowered(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def _components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {i: _set(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def _near_copies(n_groups=12, seed=3):
    """Groups of copies with more or less words changed, and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    common = [word() for _ in range(40)]
    texts = []
    for g in range(n_groups):
        base = [word() for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 12))):
                copy[rng.randrange(len(copy))] = word()
            if g % 3 == 0:
                copy = copy[: len(copy) // 2] + common + copy[len(copy) // 2 :]
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_shingle_sets():
    texts = [None, "", "A b", "a  B ", "a b c d e f", "a b c d e a b c d e a", "é\x0bx y z w"]
    tokens, at = shingle_sets(pa.array(texts))
    assert [b - a for a, b in zip(at[:-1], at[1:])] == [len(_set(t)) for t in texts]
    assert tokens[at[2]] == tokens[at[3]]
    big = pa.array(["x" * 9, None, "y" * 30, "z"])
    assert list(pieces(big, 10)) == [(0, 2), (2, 3), (3, 4)]


@pytest.mark.parametrize("seed", [3, 4])
def test_components_equal_all_pairs(spark, seed):
    texts = _near_copies(seed=seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()}
    assert got == _components(texts)


def test_a_class_of_links_found_in_the_last_round_only(spark, monkeypatch):
    """Without leader rounds every link comes from the exhaustive round."""
    monkeypatch.setattr(J, "LEADER_ROUNDS", 0)
    texts = _near_copies(n_groups=6)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()}
    assert got == _components(texts)


def test_small_blocks_and_heavy_tokens(spark, monkeypatch):
    """Tokens that most classes hold are dealt apart; blocks of few classes count alike."""
    monkeypatch.setattr(J, "HEAVY_SHARE", 10_000)
    texts = _near_copies(n_groups=9, seed=5)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()}
    assert got == _components(texts)


def test_awkward_documents(spark, awkward):
    rows = J.jaccard_components(awkward).collect()
    assert len(rows) == awkward.count()
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[0] == {(0, 0)} and got[1] == {(0, 1)} and got[2] == {(0, 2)} and got[100] == {(0, 100)}
    assert got[4] == got[5] == {(1, 4)} and got[6] == got[7] == {(3, 6)}
    assert J.jaccard_components(awkward.where("doc_id < 0")).count() == 0


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    root: dict[int, int] = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in J.connected_components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: find(i) for i in root}
    assert got == {i: r for i, r in want.items() if i != r}


def _sentences(text):
    out, cur, spans_ = [], [], [(m.start(), m.end()) for m in __import__("re").finditer(r"[^\x20\x09-\x0D]+", text)]
    for i, (a, b) in enumerate(spans_):
        cur.append((lowered(text[a:b])[0], a))
        end = i + 1 == len(spans_) or "\n" in text[b : spans_[i + 1][0]]
        if end or text[b - 1] in ".!?" or len(cur) == S.MAX_SENTENCE:
            out.append(([w for w, _ in cur], cur[0][1]))
            cur = []
    return out


def _without_repeats(texts: dict[int, str], min_words=20):
    cut = {i: _sentences(t) for i, t in texts.items()}
    seen = defaultdict(list)
    for i in sorted(cut):
        for a in range(len(cut[i])):
            b = a
            while b < len(cut[i]) and (b - a < 2 or sum(len(s[0]) for s in cut[i][a:b]) < min_words):
                b += 1
            if b - a >= 2 and sum(len(s[0]) for s in cut[i][a:b]) >= min_words:
                seen[tuple(w for s in cut[i][a:b] for w in s[0])].append((i, a, b))
    gone = defaultdict(set)
    for places in seen.values():
        for i, a, b in sorted(places)[1:]:
            gone[i].update(range(a, b))
    out = {}
    for i, text in texts.items():
        edges = [0, *[s[1] for s in cut[i]][1:], len(text)]
        keep = [text[edges[n] : edges[n + 1]] for n in range(len(edges) - 1) if n not in gone[i]]
        out[i] = ("".join(keep) if gone[i] else text, len(cut[i]), len(gone[i]))
    return out


def test_spans_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgÉ") for _ in range(rng.randint(1, 5)))
    sentence = lambda: " ".join(word() for _ in range(rng.choice([1, 4, 9, 40]))) + rng.choice([". ", "!\n", "? ", "\n\n"])
    passages = ["".join(sentence() for _ in range(8)) for _ in range(3)]
    texts = {}
    for i in range(60):
        body = [sentence() for _ in range(rng.randint(0, 6))]
        if i % 2:
            body.insert(rng.randint(0, len(body)), rng.choice(["", "glued "]) + rng.choice(passages))
        texts[i] = "".join(body) + rng.choice(["", " ", "tail"])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in S.remove_repeated_passages(docs).collect()}
    assert got == _without_repeats(texts)
    assert any(v[2] for v in got.values())


def test_spans_on_awkward_documents(spark, awkward):
    rows = S.remove_repeated_passages(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].text is None and by_id[1].text == "" and by_id[2].text == " \n\t " and by_id[0].n_sentences == 0
    assert by_id[11].text == "x" * 100_000 and by_id[11].removed == []
    assert by_id[9].n_removed > 0 and by_id[9].text.startswith("word word")
    assert by_id[3].source == "" and by_id[3].size == "clash"
    assert S.remove_repeated_passages(awkward.where("doc_id < 0")).count() == 0
    assert S.repeated_spans(awkward.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))).count() >= 1
