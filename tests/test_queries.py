"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, rows_by_name
from layerworks.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    with connect(FOLDER) as connection:
        yield connection


def test_contract(spark):
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).columns == [
        "chunk_id", "document_id", "chunk_text", "allowed_roles", "department", "chunk_index",
    ]


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    df = contract.queries()[name](spark, FOLDER)
    result = database.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    theirs = rows_by_name(columns, result.fetchall())
    assert theirs[1], "the SQL gives no rows to compare"
    assert rows_by_name(df.columns, [tuple(row) for row in df.collect()]) == theirs
