import pytest

EXTRA = "id long, ids string, n int, key string, spans string, label int, n_words int, kept boolean, comp long, found string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
PROSE = ("Once upon a time there was a small house near the wide river and the people who lived there walked to the market "
         "every morning with baskets full of bread and apples they had made the evening before while singing old songs")


def doc(i, text, lang="en", source="src1"):
    return (i, text, lang, source, len(text or ""), 1, "x", 2, "k", "s", 0, 3, True, 4, "f")


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with extra columns whose names the operators use themselves."""
    return lambda rows: spark.createDataFrame([r if len(r) > 5 else doc(*r) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    return [
        (1, PROSE), (1, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t "), (6, "word"), (None, PROSE), (7, "x" * 50_000),
        (8, (PROSE + ".\n") * 400), (9, "\U0001f600 a@b.co \U0001f600", None, None), (10, "ab\x00cd \x1c e", None, "src2"),
        (None, None, None, None),
    ]


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    return make(odd_rows)


@pytest.fixture(scope="session")
def empty(make):
    return make([])
