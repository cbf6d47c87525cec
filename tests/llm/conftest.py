import pytest
from edge_texts import TEXTS
from pyspark.sql import functions as F

from reviewmart.llm.common import find_package


@pytest.fixture(scope="session")
def edges(spark):
    """Null ids, null and empty texts, a repeated row, long texts, and columns with taken names."""
    find_package(spark)
    rows = [(i, t, ("en", "de", None)[i % 3], "s", i) for i, t in enumerate(TEXTS)]
    rows += [rows[8], (None, "the same text of six words", "en", None, None), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clashing = ("score", "node", "key", "piece", "held", "lang_pred", "row", "part", "word", "kept", "runs", "crc")
    return spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in clashing}).repartition(3)


@pytest.fixture(scope="session")
def documents(spark, sf):
    find_package(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")
