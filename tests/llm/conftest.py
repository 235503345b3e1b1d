import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF_DIR = "/root/testdata/sf0.01"

#: Texts that are odd in one way each.
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n\t",
    "a",
    "one two three",
    "the cat sat on the mat. the cat sat on the mat. the cat sat",
    "Ünïcode ñ ß 漢字  nbsp  sep \x1cctl é ́x",
    "don't <|endoftext|> a<|endoftext|>b 12345 !!! ȩ́",
    "same line\nsame line\n\nother line\nsame line",
    "word " * 3000,
    "x" * 5000,
]


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts, a null id, a repeated row, and columns whose names an operator may use itself."""
    rows = [(i, t, "en", "s", 0, "x", "y") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a null id", None, None, None, None, None), rows[6], (3, "id 3 again", "", "", 1, "", "")]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "block string, _hash string",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
