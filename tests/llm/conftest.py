import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def ready(spark):
    from riskline.session import prepare

    prepare(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns that clash with working names."""
    long_text = " ".join(f"word{i % 977} tail{i % 13}." for i in range(40_000))
    rows = [
        (None, None, None, None, None, 1, "a"),
        (1, "", "en", "b", 0, 2, "b"),
        (2, " \n\t ", "en", "b", 4, 3, None),
        (3, "one two three four five six seven\nline two here", "en", "a", 48, 4, "c"),
        (3, "one two three four five six seven\nline two here", "en", "a", 48, 4, "c"),
        (4, "one two three four five six seven\nline two here", None, None, 48, None, "c"),
        (5, long_text, "en", "c", len(long_text), 5, "d"),
        (None, "text without id, mail a.b@example.org and +1 (555) 123-4567", "en", "a", 10, 6, "e"),
        (6, "naïve çà 日本語 ▁ token = \"0a1b2c3d4e5f60718293\" x", "fr", "ü", 20, 7, "f"),
    ]
    return spark.createDataFrame(rows, DOC + ", `row` int, kept string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)
