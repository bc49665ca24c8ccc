import pytest


@pytest.fixture(scope="session")
def llm(spark):
    from wareflow.llm.common import ship
    return ship(spark)


@pytest.fixture()
def odd(llm):
    """Nulls, empty, white space only, repeated rows, a long text, clashing column names."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t", None), (4, "One two  three four five six!", "c"), (4, "One two  three four five six!", "c"),
            (None, "no id here at all, sir", "d"), (5, long, "e"), (6, long, "f"), (7, "tie <|endoftext|> 中文", "g")]
    return llm.createDataFrame(rows, "doc_id long, text string, row string")


@pytest.fixture()
def empty(llm):
    return llm.createDataFrame([], "doc_id long, text string, row string")
