import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, a clashing extra column."""
    words = "the quick brown fox jumps over a lazy dog while rain falls on the old mill by the river".split()
    long = " ".join(words[(k * k) % len(words)] + str(k % 97) for k in range(20_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
        (3, "", "en", "a", 0),
        (4, None, None, None, None),
        (None, "words without an id stand here", "en", "b", 30),
        (5, "\n \t \n", "en", "b", 5),
        (6, "日本語 テスト 🙂🙂 <|endoftext|> x\x00y", "xx", "ü", 20),
        (7, long, "en", "b", len(long)),
        (8, "a", None, "b", 1),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", slot string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
