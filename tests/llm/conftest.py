import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "one two three",
    "same words here again and more of them to make a line",
    "same words here again and more of them to make a line",
    "SAME words here again and more of them to make a line",
    "a b c\na b c\n\n a b c \nx" * 30,
    "x" * 5000 + " " + "7" * 3000 + " end",
    "1.2.3.4 and 300.1.1.1 or me@a.bc_x@y.zz 4111 1111 1111 1111 +1 (212) 555-0199 \x1c café \U0001f600 5.6.7.8",
    "word " * 3000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, equal rows, and columns whose names clash with those operators make."""
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 4}", "shard", 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id at all in this row", None, None, None), (5, ODD_TEXTS[5], "s1", "shard", 7), (5, ODD_TEXTS[5], "s1", "shard", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, shard string, size int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
