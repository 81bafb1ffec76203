import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang]) rows, with columns whose names operators use inside."""
    def build(rows):
        rows = [(*row, "en")[:3] for row in rows]
        return spark.createDataFrame([(d, t, lang, "s", -1 if t is None else len(t), 7, "x") for d, t, lang in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, digest int, fp string")
    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, blanks, a long text, ties, repeated rows and a repeated id."""
    long = "Many words make one very long text. " * 4000 + "x" * 50_000
    return make([(0, None), (1, ""), (2, " \t\n "), (3, "Hello world"), (3, "Hello world"), (4, "Helloworld"), (5, "Hello  world"),
                 (6, long), (7, long + " "), (None, "No id here at all"), (None, None), (8, "12 34 !!"), (3, "Another text of the same id"),
                 (9, "日本語のテキスト"), (10, "é ▁ \x1c z")])
