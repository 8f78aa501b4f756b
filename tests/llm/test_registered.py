"""The registered queries of the operators."""

from pathlib import Path

import pytest
from oracle_compare import connect, difference

import __spark_entry__ as entry
from ledgerflow.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")


def test_all_are_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{number}" for number in range(1, len(QUERIES) + 1)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op8_packing"}))
def test_query_gives_a_row_for_each_document(spark, name):
    found = QUERIES[name](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found.count() == documents.count()
    assert found.select("doc_id").exceptAll(documents.select("doc_id")).count() == 0
