import pytest

LONG = " ".join(f"word{i % 97}x{i % 13}" for i in range(30_000))
DOCS = [
    (1, "A shared line here\nonly one\nthe end", "en", "s", 1),
    (2, "a SHARED line here  \nother text\n\nthe end", "en", "s", 2),
    (2, "a SHARED line here  \nother text\n\nthe end", "en", "s", 2),      # repeated row
    (3, None, "en", None, None),
    (4, "", None, "s", 0),
    (5, " \n\t ", "fr", "s", 4),
    (None, "a shared line here\nno id", "en", "s", 5),
    (7, "Straße ÉTÉ été 日本語 \U0001f600 x²", "de", "s", 6),
    (8, LONG, "en", "s", 7),
    (9, LONG + " tail", "en", "s", 8),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeats, clashing names."""
    df = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    return df.selectExpr("*", "1 AS shard", "2 AS score", "3 AS n_lines", "'x' AS ids", "'y' AS part", "4 AS did", "5 AS print")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
