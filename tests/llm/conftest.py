import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts or (doc_id, text, lang, source) rows."""

    def build(rows):
        full = []
        for at, row in enumerate(rows):
            doc_id, text, lang, source = row if isinstance(row, tuple) else (at, row, "en", f"src{at % 3}")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def given(spark):
    """Small given documents with null, empty, repeated and long texts added, and a column of a clashing name."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = spark.createDataFrame(
        [
            (900_001, None, "en", "src1", None),
            (900_002, "", None, None, 0),
            (900_003, " \n\t ", "en", "src2", 4),
            (900_004, "aaaa " * 30_000, "en", "src2", 150_000),
            (900_005, "x" * 100_000, "en", "src2", 100_000),
            (900_006, "same text here", "en", "src0", 14),
            (900_006, "same text here", "en", "src0", 14),
            (900_007, "naïve café 日本語 ё😀 text with spaces\x1c!", "fr", "src0", 40),
        ],
        SCHEMA,
    )
    return docs.unionByName(more).withColumn("found", F.lit("mine")).cache()
