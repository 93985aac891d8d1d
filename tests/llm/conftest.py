import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def rows():
    from cases import documents

    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from cases import SCHEMA

    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, texts and sources, repeated rows and ids, and columns whose names the operators use inside."""
    some = " ".join(f"w{i}" for i in range(40))
    rows = [(None, some, None, None, 1), (None, None, "en", "a", 2), (5, some, "en", "a", 3), (5, some, "en", "a", 3), (5, "other text", "en", None, 3), (9, None, None, "b", 4), (9, "", "fr", "b", 5), (2, some + " end", "en", "a", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _id long").withColumns({c: __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1) for c in ("_text", "home", "key", "_key", "size", "id", "group")})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
