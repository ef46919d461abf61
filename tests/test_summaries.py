import fixtures
import pytest
from pyspark.sql import functions as F

from layerworks.operators import summaries
from layerworks.plans.tables import append_table, drop_table, overwrite_table
from layerworks.sources.literals import literal_rows


@pytest.fixture
def employees(spark):
    return literal_rows(spark, fixtures.EMPLOYEES, ["emp_id", "name", "dept", "base_salary", "age"])


@pytest.fixture
def departments(spark):
    return literal_rows(spark, fixtures.DEPARTMENTS, ["dept", "dept_name_jp", "location"])


def test_literal_rows(spark, employees):
    assert dict(employees.dtypes)["base_salary"] == "bigint"
    assert [tuple(row) for row in employees.collect()] == fixtures.EMPLOYEES
    assert literal_rows(spark, [(None, 1)], ["a", "b"]).first() == (None, 1)


def test_filter(employees):
    rows = summaries.at_least(employees, ["emp_id", "base_salary"], "base_salary", 400000).collect()
    assert [row.emp_id for row in rows] == ["E002", "E003", "E004", "E006", "E008"]


def test_bands(employees):
    label = summaries.band(F.col("age"), [(30, "20s"), (40, "30s"), (50, "40s")], "50s+")
    thousands = summaries.in_thousands(F.col("base_salary"))
    rows = employees.select("emp_id", label.alias("g"), thousands.alias("k")).collect()
    assert [row.g for row in rows] == ["20s", "30s", "40s", "30s", "30s", "40s", "20s", "50s+"]
    assert [row.k for row in rows] == [350.0, 520.0, 410.0, 480.0, 380.0, 610.0, 290.0, 430.0]


def test_summary_in_both_forms(employees):
    expected = [("Engineering", 3, 536667.0, 610000), ("HR", 2, 405000.0, 430000), ("Sales", 3, 350000.0, 410000)]
    frame = summaries.summarize(employees, "dept", "base_salary")
    text = summaries.summarize_sql(employees, "dept", "base_salary", "emp_view")
    assert [tuple(row) for row in frame.collect()] == expected
    assert [tuple(row) for row in text.collect()] == expected


def test_join_and_sort(employees, departments):
    joined = summaries.with_dimension(employees, departments, "dept")
    assert joined.columns.count("dept") == 1
    rows = joined.orderBy("dept", "emp_id").select("emp_id", "location").collect()
    assert [row.emp_id for row in rows] == ["E002", "E004", "E006", "E005", "E008", "E001", "E003", "E007"]
    # Sorting by a column the projection leaves out.
    assert [r.name for r in employees.select("name").orderBy("age").collect()][:2] == ["Yamamoto", "Sato"]


def test_show_and_schema(employees, capsys):
    employees.printSchema()
    employees.show(2)
    shown = capsys.readouterr().out
    assert "base_salary: long" in shown and "only showing top 2 rows" in shown


def test_tables(spark, employees, table_names):
    name = table_names("employees")
    summary = overwrite_table(summaries.summarize(employees, "dept", "base_salary"), name, "it's a summary")
    assert summary.count() == 3
    overwrite_table(employees.select("emp_id"), name)
    assert spark.table(name).columns == ["emp_id"]
    append_table(employees.select("emp_id"), name)
    assert spark.table(name).count() == 16
    drop_table(spark, name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
