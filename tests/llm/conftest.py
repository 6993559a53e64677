import pytest

EDGES = [None, "", " ", "\n\t", "word", "a b", "x" * 30000, "é ß 日本 😀   ▁ <s>", "same same same same", "a b", "\x00 \x1c"]


@pytest.fixture
def odd(spark):
    """Documents with nulls, edge texts, a repeated row, and extra columns with clashing names."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", 1, "x") for i, t in enumerate(EDGES)]
    rows += [rows[5], (None, "a b c d", "en", "s", 1, "x")]
    names = "doc_id bigint, text string, lang string, source string, n int, component string"
    return spark.createDataFrame(rows, names)


@pytest.fixture
def marks(spark):
    return spark.createDataFrame(
        [(4, 1, 0), (6, 0, 1), (5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int"
    )


@pytest.fixture
def keep():
    """Tables are kept as they are."""
    return lambda df, label: df
