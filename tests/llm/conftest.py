import pytest

LONG = "alpha beta gamma delta " * 6000


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, source) with columns whose names operators use too."""
    def build(*rows):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, "
                  "size string, shard string, h string, n_words string, kept string, n_lines string, _th string, n string")
        return spark.createDataFrame(
            [(i, t, "en", s, 1, "a", "b", "c", "d", "e", "f", "g", "h") for i, t, s in rows], schema)

    return build


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and very long texts, repeated rows and ids."""
    return documents(
        (1, None, "a"), (2, "", "a"), (3, "   \n\t", None), (None, "one two three", "b"), (None, "four five", None),
        (4, LONG, "b"), (5, "same text here", "b"), (5, "same text here", "b"), (5, "another text", "b"), (6, "same text here", "c"))


@pytest.fixture
def labels(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build
