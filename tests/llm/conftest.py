import pytest

LONG = "alpha beta gamma delta " * 4000 + "end"

#: Nulls in any column, empty, blank and long texts, ties, and a row repeated as a whole.
EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "s1", 10),
    (2, None, None, None, None),
    (3, "", "en", "s1", 0),
    (4, " \n\t ", "en", None, 4),
    (5, LONG, "en", "s2", len(LONG)),
    (6, "The quick  brown fox\njumps over the lazy dog.", "en", "s2", 10),
    (7, "naïve été 日本語 ▁ \U0001f600 end", "fr", "sé", 9),
    (8, LONG, "en", "s2", len(LONG)),
    (8, LONG, "en", "s2", len(LONG)),
    (None, "no id here, only a text", "en", "s1", 5),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    """Extra columns with names that operators use inside."""
    from pyspark.sql import functions as F

    names = ("id th hash bits slot bucket keep_id kept size copies rows nth fp n listed alike key piece_ids parts "
             "n_entities by sweep depth").split()
    return edge.select("*", *[F.lit("x").alias(n) for n in names])
