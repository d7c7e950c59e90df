from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from data import SF  # noqa: E402

#: Names the operators use inside.
CLASHING = "row z spans passes upto n ids h fp rep least place anchor name windows start key kept _id _h _tag _kept _copies _score count".split()


@pytest.fixture(scope="session")
def texts():
    """doc_id -> text of the smallest documents table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall())


ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "a"), (4, "x", "de", None), (5, "two words", "en", "b"),
    (6, "ein Satz " * 30, "de", "b"), (6, "ein Satz " * 30, "de", "b"), (7, "ein Satz " * 30, "de", "c"), (None, "no id here " * 20, "en", "c"),
    (None, None, None, None), (8, "Straße É 漢字 🙂 <|endoftext|> </s> 's don't " * 9, "fr", "d"), (9, "12345 !!! ... \x00 \x1c", None, "d"),
    (10, " ".join(f"w{i * i % 7919}" for i in range(120_000)), "en", "long"), (10, "other text of one id", "en", "b"),
    (11, "y" * 300_000, "en", "long"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, ties, repeats, and columns whose names clash."""
    rows = [(*r, len(r[1] or ""), *range(len(CLASHING))) for r in ODD]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHING)
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
