from __future__ import annotations

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from daymark.llm import catalog
from daymark.llm.manifest import document_leaf, fold, proofs, siblings, write_manifest
from daymark.session import shared_dir
from tests.conftest import SF_SMALL


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes: list[str], fan: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return levels


def path_of(levels: list[list[str]], place: int, fan: int) -> list[tuple[str, str]]:
    out = []
    for nodes in levels[:-1]:
        start = place // fan * fan
        run = nodes[start : start + fan]
        out.append(("".join(run[: place - start]), "".join(run[place - start + 1 :])))
        place //= fan
    return out


def brute(rows: list[tuple], fan: int) -> tuple[str, dict]:
    """Root, and for each (source, id) in order its (leaf, subroot, path)."""
    groups: dict = {}
    for ident, source, leaf in rows:
        groups.setdefault(source, []).append((ident is not None, ident, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2]))], fan) for s in names}
    top = levels_of([trees[s][-1][0] for s in names], fan)
    out: dict = {}
    for at, s in enumerate(names):
        for place, (_, ident, leaf) in enumerate(sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2]))):
            out.setdefault((s, ident, leaf), []).append((trees[s][-1][0], path_of(trees[s], place, fan) + path_of(top, at, fan)))
    return (top[-1][0] if names else sha("")), out


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


@pytest.mark.parametrize(("fan", "stride", "sizes"), [(16, 2, (1, 2, 16, 17, 256, 257, 600)), (2, 3, (1, 2, 3, 7, 8, 9, 31, 64, 65)), (3, 1, (1, 3, 4, 28))])
def test_paths_equal_a_tree_built_in_memory(spark, fan, stride, sizes):
    rows = [(1000 * g + i, f"s{g}" if g else None, f"t{i}") for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    leaf = F.sha2(F.concat_ws("/", "doc_id", "text"), 256)
    m = write_manifest(docs, shared_dir(spark, "t13"), leaf=leaf, fan_out=fan, stride=stride)
    root, want = brute([(i, s, sha(f"{i}/{t}")) for i, s, t in rows], fan)
    assert m.root == root
    # Of the levels of the largest tree every stride-th is kept, no other.
    height = max(math.ceil(round(math.log(max(sizes), fan), 9)), 1)
    assert list(m.stored) == list(range(0, m.stored[-1] + 1, stride)) and m.stored[-1] < height + stride
    got = proofs(spark, m).withColumns({"folded": fold(F.col("leaf"), F.col("path")), "all": siblings(F.col("path"))}).collect()
    assert len(got) == len(rows)
    for r in got:
        ((subroot, path),) = want[(r.source, r.ident, r.leaf)]
        assert r.subroot == subroot and [tuple(p) for p in r.path] == path
        assert r.folded == root and r.all == "".join(a + b for a, b in path)


def test_awkward_rows(spark, awkward):
    """Nulls everywhere, repeated rows, clashing columns; a leaf is the row's five fields."""
    docs = awkward.withColumn("n_chars", F.length("text").cast("long"))
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    m = write_manifest(docs, shared_dir(spark, "t13"), leaf=document_leaf(F.col("text")))
    leaves = [(r.doc_id, r.source, sha("".join(field(v) for v in r))) for r in rows]
    root, want = brute(leaves, 16)
    assert m.root == root
    got = proofs(spark, m).withColumn("folded", fold(F.col("leaf"), F.col("path"))).collect()
    assert len(got) == len(rows) and {r.folded for r in got} == {root}
    for key, paths in want.items():
        mine = [(r.subroot, [tuple(p) for p in r.path]) for r in got if (r.source, r.ident, r.leaf) == key]
        assert sorted(mine) == sorted(paths)
    other = write_manifest(docs.repartition(3), shared_dir(spark, "t13"), leaf=document_leaf(F.col("text")))
    assert other.root == root


def test_empty_table(spark, awkward):
    m = write_manifest(awkward.where("doc_id < 0"), shared_dir(spark, "t13"), leaf=document_leaf(F.col("text")))
    assert m.root == sha("") and proofs(spark, m).count() == 0


def test_tampered_leaves_do_not_verify(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in catalog.QUERIES["op13_merkle_manifest"](spark, SF_SMALL).collect():
        text = docs[r.doc_id].text
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in text)
        assert r.verified is (not changed) and (r.folded_root == r.root) is r.verified
