from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


AWKWARD = [
    None, "", " \n\t ", "one", "One two three", "one two three", "a b c d e f g.", "A B c d e f G.",
    "Straße é漢字 \x0b\x0c\r x", "word " * 30000, "👍\n\n\nb\n \nc", "x" * 100_000, "same text twice. " * 3,
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, repeated rows and columns named like the operators' own."""
    rows = [(i, t, ["a", "b", None, ""][i % 4], None if i % 3 else "en") for i, t in enumerate(AWKWARD)]
    rows += [rows[6], rows[6], (None, "a null id here.", "a", None), (100, None, None, None)]
    schema = "doc_id long, text string, source string, lang string"
    own = {c: "'clash'" for c in ("size", "shard", "slot", "score", "ids", "part", "piece_ids", "n_removed", "removed", "fingerprint", "n_chars")}
    return spark.createDataFrame(rows, schema).selectExpr("*", *[f"{v} AS {c}" for c, v in own.items()])
