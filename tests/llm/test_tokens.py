from __future__ import annotations

import dataclasses
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from daymark.llm import catalog, sentencepiece as S, tokens as TK  # noqa: E402
from daymark.session import shared_dir  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

HARD = [
    None, "", " ", "  ", "   a", "a\n\nb \n c", "\n", "\na", "a \n", "Hello  world\n  foo\tbar é 漢 ", "▁a b \x00 c", "a▁▁b",
    "     x     \n      y", "\0\n \0", "<s> </s> <0x0A> <|endoftext|>", "a" * 28, "👍👍 ok👍", " x y", "x" * 3000, " " * 40,
    "it's I'll\n's x 's", "\x85a \x85 b\x1c c \xa0 d", "1 2  3\r\n4 \r\n 5",
]


def _hard(n=3000):
    rng = random.Random(7)
    return HARD + ["".join(rng.choice(" \n\t\xa0ab1'.s\r▁é漢") for _ in range(30)) for _ in range(n)]


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, part string, ids int")


def test_piece_ids_equal_the_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), S.load_model(path)
    texts = _hard()
    both = S.encode_documents(_frame(spark, texts), model, decoded_col="at_once")
    rows = S.decode_documents(both, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.piece_ids == sp.encode(r.text or ""), repr(r.text)
        assert r.decoded == r.at_once == sp.decode(r.piece_ids)
        assert r.part == "x"


def test_unigram_viterbi_equals_the_library(tmp_path):
    """The same pieces read as a unigram model (best sum of scores)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = 0.0 if p.type != 1 else -1.0 - abs(max(p.score, -40000.0)) / 8192
    (tmp_path / "u.model").write_bytes(proto.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "u.model"))
    encoder = S.Encoder(S.load_model(str(tmp_path / "u.model")))
    texts = ["the quick brown fox", "antidisestablishmentarianism of nations", "étions élevées", "a  b"]
    flat, off = encoder.encode(pa.array(texts))
    for row, text in enumerate(texts):
        ours, theirs = flat[off[row] : off[row + 1]].tolist(), sp.encode(text)
        total = lambda ids: sum(proto.pieces[i].score for i in ids)  # noqa: E731  ties may be cut either way
        assert total(ours) == pytest.approx(total(theirs), abs=1e-3)
        assert sp.decode(ours) == text


def test_shared_prefixes_do_not_change_results():
    encoder = S.Encoder(S.load_model(public_tokenizers.path("piece_bpe_32k.model")))
    words = ["▁the", "▁then", "▁there", "▁thereby", "▁thermal", "▁a", "▁ab", "▁xyz"]
    together = encoder.learn(words)
    for w in words:
        assert encoder.learn([w])[w].tolist() == together[w].tolist()


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    texts = [*_hard(), "a <|endoftext|> b", "<|endoftext|>", "x\n<|endoftext|><|endoftext|> the"]
    docs = _frame(spark, texts).repartition(5)
    docs = docs.unionByName(docs.where("doc_id = 9"))  # a repeated row
    for encoding, as_text in (("dictionary", False), ("delta", True)):
        out = shared_dir(spark, "test-op6")
        tk.encode_special_tokens = as_text
        TK.write_token_files(docs, out, path, encoding=encoding, special_as_text=as_text)
        back = TK.read_token_files(spark, out)
        rows = back.orderBy("start").collect()
        at = 0
        for r, want in zip(rows, sorted([*range(len(texts)), 9])):
            ids = [*tk.encode(texts[want] or "", add_special_tokens=False).ids, 0]
            assert (r.doc_id, r.start, r.n_tokens, r.ids) == (want, at, len(ids), ids)
            at += len(ids)
        assert any(50256 in r.ids for r in rows) is not as_text
        some = TK.ids_crc32(back.where("doc_id = 0")).collect()
        assert [r.ids_crc32 for r in some] == [zlib.crc32(b"\0\0\0\0")]
    slim = TK.read_token_files(spark, out, columns=("doc_id", "start"))
    plan = slim.where("doc_id > 5")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(doc_id,5)" in plan and not re.search(r"ReadSchema: \S*\bids:", plan)


def test_full_caches_keep_what_is_used_again():
    """A small cache gives the same ids, and does not learn again what every block has."""
    from daymark.llm.units import UnitCache

    learned: list[bytes] = []

    def encode_units(units, plain):
        learned.extend(units)
        return [np.frombuffer(u, np.uint8).astype(np.int32) for u in units]

    rng = random.Random(3)
    cache = UnitCache(encode_units, max_units=300)
    for _ in range(40):
        texts = [" ".join(["all", "have", "these", *(f"w{rng.randrange(10**6)}" for _ in range(60))]) for _ in range(2)] + ["", None]
        ids, off = cache.encode(pa.array(texts))
        assert [bytes(ids[a:b].astype(np.uint8)).decode() for a, b in zip(off[:-1], off[1:])] == [t or "" for t in texts]
        assert cache.n_units <= 300
    assert [learned.count(u) for u in (b"all", b" have", b" these")] == [1, 1, 1]


def test_merging_long_runs_of_marks_is_not_quadratic():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, encoder = sentencepiece.SentencePieceProcessor(model_file=path), S.Encoder(S.load_model(path))
    for text in (" " * 300_000 + "x", "a" + " " * 4001 + "b" + " " * 17, "ab" * 20 + " " * 33):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == sp.encode(text)


def test_models_that_differ_anywhere_have_their_own_encoder():
    model = S.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    other = dataclasses.replace(model, dummy_prefix=not model.dummy_prefix)
    assert S._encoder(model) is S._encoder(model)
    assert S._encoder(other).model is other and S._encoder(model).model is model


def test_hashes_need_only_small_tables():
    from daymark.llm import words as W

    for n in (1, 65_536, 65_537, 300_000):
        powers = W._powers(W._BASE, n)
        assert len(powers) == n and int(powers[-1]) == pow(W._BASE, n - 1, 2**64)
    assert all(len(t) == 1 << 16 for t in W._POWERS.values())


def test_empty_tables(spark):
    empty = _frame(spark, ["a"]).where("doc_id < 0")
    out = shared_dir(spark, "test-op6")
    TK.write_token_files(empty, out, public_tokenizers.path("byte_bpe_50k.json"))
    assert TK.ids_crc32(TK.read_token_files(spark, out)).count() == 0
    model = S.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    assert S.decode_documents(S.encode_documents(empty, model), model).count() == 0


def test_queries(spark):
    ids = catalog.QUERIES["op10_sentencepiece"](spark, SF_SMALL)
    assert ids.where(~F.col("round_trip")).count() == 0
    got = catalog.QUERIES["op6_token_files"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
