import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i} and{i % 97}" for i in range(30_000))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    plain = "The cat sat on the mat while the dog slept under the old table near the open door of the house today."
    return [(1, plain, "en", "a", 100), (2, plain, "en", "a", 100), (2, plain, "en", "a", 100), (3, None, "en", "a", 0),
            (4, "", "en", None, 0), (None, plain + " again", None, None, None), (None, plain + " again", None, None, None),
            (5, " \t\n\x0b ", "en", "b", 5), (6, LONG, "en", "b", len(LONG)), (7, "one", "en", "b", 3),
            (8, "a b c d e f g h " * 30, "en", "c", 480)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clash(edge):
    """Further columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    names = ["size", "start", "shard", "cid", "n", "token", "_k1", "_body", "_w", "_chunk", "n_words", "score", "_score", "block", "slice"]
    return edge.select("*", *[F.lit("x").alias(c) for c in names])
