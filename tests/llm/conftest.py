import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHES = ("size", "h", "slice", "fp", "th", "row", "id", "of", "kept", "component", "spans", "copies", "chunk", "u", "v", "root", "gram", "part")


def words(n: int, seed: int) -> str:
    """Words that no other seed has."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a long text, ties, repeated rows, clashing columns."""
    long = words(30_000, 1)
    rows = [
        (1, "The first text of all, with a few more words.", "en", "a", 1),
        (2, "The first text of all, with a few more words.", "en", "a", 1),
        (2, "The first text of all, with a few more words.", "en", "a", 1),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \t\n\x0b\x0c\r ", "de", "b", 7), (6, "12 345 !?", "de", "b", 9),
        (7, long, "fr", None, len(long)), (None, "A text without a number, that stands by itself here.", None, "c", None),
        (8, "Ein kurzer Text mit Wörtern und Ümläuten, der für sich steht.", "de", "b", 60), (9, "x", "fr", "", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for i, name in enumerate(CLASHES):
        df = df.selectExpr("*", f"{i} AS `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
