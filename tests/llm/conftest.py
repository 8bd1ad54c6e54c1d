import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

NASTY = ["", None, " \n\t ", "!!!", "a", "One two three", "Ünïcode straße İstanbul ΟΔΥΣΣΕΥΣ <|endoftext|> x<|endoftext|>y",
         "word " * 5000, "tab\tand\x0bvertical\x1cnot space", "é combining J̌", "日本語 テスト 🙂🙂"]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def real_docs():
    import pyarrow.parquet as pq
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls, blanks, ties, repeated rows, a very long text and extra columns with clashing names."""
    rows = [(i, t, None if i % 3 else "en", "s", 1, 0.5, "x") for i, t in enumerate(NASTY)]
    rows += [rows[5], rows[6], (None, "no id here at all", "en", None, None, None, None), (40, "One two three", "fr", "s", 1, 0.1, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, rep string").repartition(3)


@pytest.fixture(scope="session")
def empty(nasty):
    return nasty.where("false")
