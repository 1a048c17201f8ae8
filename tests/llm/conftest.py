import pytest

LONG = " ".join(f"word{i} and" for i in range(40_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with names that operators use."""
    rows = [
        (1, "The same words come twice here.", "en", "s", 31, "a", 1),
        (1, "The same words come twice here.", "en", "s", 31, "a", 1),
        (2, None, None, None, None, None, None),
        (None, "A row without an id has words too.", "en", None, 3, "b", 2),
        (None, None, None, None, None, None, None),
        (3, "", "fr", "s", 0, "", 0),
        (4, LONG, "en", "s", len(LONG), "c", 3),
        (5, " \n\t ", "de", "s", 4, "d", 4),
        (6, "123 456 !!", None, "s", 10, "e", 5),
        (7, "é à 日本 ▁ \x00 end", "fr", "s", 9, "f", 6),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row string, at int"
    ).selectExpr("*", "row as key", "row as fp", "at as ids", "row as kept", "at as n_words", "row as lang_pred", "at as score")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
