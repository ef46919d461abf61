import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from layerworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, name="layerworks-tests")
    yield session
    session.stop()


@pytest.fixture
def plan(spark):
    """Text of the physical plan of a DataFrame."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def table_names(spark):
    """Names for tables that are dropped, with their data, after the test."""
    import uuid

    made = []

    def name(label):
        made.append(f"{label}_{uuid.uuid4().hex[:8]}")
        return made[-1]

    yield name
    for table in made:
        for row in spark.sql(f"SHOW TABLES LIKE '{table}*'").collect():
            if not row.isTemporary:
                kind = "VIEW" if row.tableName == table and _is_view(spark, table) else "TABLE"
                spark.sql(f"DROP {kind} IF EXISTS {row.tableName}")


def _is_view(spark, name):
    return spark.catalog.getTable(name).tableType == "VIEW"
