import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
AWKWARD = [
    (None, "alpha beta gamma delta epsilon zeta eta theta", None, None, None),
    (1, None, "en", "s", 0),
    (2, "", "en", "s", 0),
    (3, " \t\n ", "en", None, 4),
    (4, "one", None, "s", 3),
    (4, "one", None, "s", 3),
    (5, "word " * 30000, "en", "s", 150000),
    (6, "Ünïcödé 日本語 \U0001f600 text\x00with\x0bodd\x85spaces", "x", "s", 5),
]


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def awkward(make):
    """Nulls, empty, blank and very long texts, repeated rows, a null id, and columns whose names clash with the operators' own."""
    clashing = ["length", "rep", "n", "window", "score", "label", "pair", "component"]
    return make(AWKWARD).withColumns({c: F.lit("x") for c in clashing})


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def folder():
    from pathlib import Path

    path = "/root/testdata/sf0.001"
    if not Path(path).exists():
        pytest.skip("no test tables")
    return path


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").cache()
