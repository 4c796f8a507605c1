import pytest
from pyspark.sql import types as T

TEXTS = {
    1: "the quick brown fox jumps over the lazy dog and then it sleeps in the warm sun all day",
    2: "the quick brown fox jumps over the lazy dog and then it sleeps in the warm sun all day",
    3: "The Quick brown fox jumps over the lazy dog and then it sleeps in the warm sun all night",
    4: None,
    5: "",
    6: " \t\n ",
    7: "one two",
    8: "One two",
    9: "é日本 ü " * 5 + "x" * 3000,
    10: "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho",
    11: "start alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho end",
}
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # names that operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("id", "row", "score", "n", "fp", "key", "range", "slot")],
    ]
)


def rows_of(texts):
    return [(i, t, *["x"] * 8) for i, t in texts]


@pytest.fixture(scope="session")
def texts():
    return dict(TEXTS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows_of(TEXTS.items()), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, rows that share an id, and rows without an id."""
    some = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other words stand here now ok"), (None, "a b c d e f g"), (None, None), (2, "a b c d e f g")]
    return spark.createDataFrame(rows_of(some), SCHEMA)
