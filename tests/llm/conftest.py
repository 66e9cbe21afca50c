import pytest

#: Texts that every operator has to handle (id, text, lang, source, n_chars).
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (None, "no id here", "de", "b", 10), (None, None, None, None, None),
    (3, " \n\t ", "en", "a", 4), (4, "one", "fr", "a", 3), (5, "word " * 60_000, "en", "a", 300_000),
    (6, "x" * 200_000, "en", "a", 200_000), (7, "same text twice", "en", "a", 15), (7, "same text twice", "en", "a", 15),
    (7, "same id, other text", "en", "a", 19), (8, "Ünïcödé 日本語 \U0001f600 \x00 ſ K", "de", "b", 20),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns with names that operators use inside.
CLASH = {"t": "1", "node": "2", "id": "3", "length": "4", "block": "5", "k0": "6", "rules": "7", "metrics": "8", "w": "9"}


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def odd_clash(odd):
    from pyspark.sql import functions as F

    return odd.withColumns({k: F.lit(v) for k, v in CLASH.items()})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    from ..conftest import SF_SMALL

    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def sf(spark):
    from ..conftest import SF_SMALL

    return SF_SMALL
