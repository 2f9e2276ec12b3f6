import pytest

SMALL = "/root/testdata/sf0.001"

#: Texts that every operator must take: null, empty, blank, odd, repeated, long.
ODD_TEXTS = [None, "", "   \n\t ", "a", "Ünï cödé ß 漢字 😀", "same text here", "same text here", "word " * 3000,
             "x" * 20_000, "12 34 !!"]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def odd(spark):
    """Odd texts with a null id, repeated rows, and columns whose names clash
    with those the operators make themselves."""
    rows = [(i, t, "en", 1, "k", 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "same text here", None, 2, None, 1), rows[5]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, n_words int, label string, fp int")
