import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, id string, numbers string, held_out string, code string"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, odd characters; columns whose names operators use."""
    long = "word other thing, " * 12000
    texts = [(1, None), (2, ""), (3, "   \n\t "), (4, long), (5, "same text here"), (5, "same text here"), (6, "same text here"), (None, "no id at all"), (7, "Ünïcode ﬁ 日本 K <|endoftext|> \x1c x"), (8, "\n".join(["a line of the page"] * 60)), (None, None), (9, "one"), (10, "!!! ### ***")]
    return [(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else "src", 0, 0.5, "r", "x", "n", "h", "c") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")
