import pytest
from pyspark.sql import Observation
from pyspark.sql.types import StringType, StructField, StructType

from layerworks.operators.quality import (
    apply_expectations,
    expect,
    expect_or_drop,
    expectation_metrics,
    not_null_expectations,
)
from layerworks.plans.datasets import materialized_view, publish

RULES = [expect_or_drop("has_id", "id IS NOT NULL"), expect("positive", "v > 0")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, 5), (None, -5), (2, None), (3, -1)], "id int, v int")


def test_metrics_count_unknown_answers_as_failures(rows):
    got = [tuple(row) for row in expectation_metrics(rows, RULES).collect()]
    assert got == [("has_id", "drop", 3, 1), ("positive", "warn", 1, 3)]


def test_counting_and_dropping_while_writing(rows):
    observation = Observation()
    kept = apply_expectations(rows, RULES, observation)
    kept.write.format("noop").mode("overwrite").save()
    # Both predicates were counted on the rows before any was dropped.
    assert observation.get == {"rows": 4, "has_id": 1, "positive": 3}
    assert sorted(row.id for row in kept.collect()) == [1, 2, 3]


def test_warnings_alone_keep_every_row(rows):
    assert apply_expectations(rows, RULES[1:]).count() == 4


def test_publishing_no_rows(spark, tmp_path, table_names):
    name = table_names("none")
    dataset = materialized_view(
        name, lambda spark: spark.createDataFrame([], "id int, v int"), "", RULES
    )
    assert publish(spark, dataset, str(tmp_path)) == {"rows": 0, "has_id": 0, "positive": 0}
    assert spark.table(name).count() == 0


def test_expectations_from_a_schema(spark, rows):
    schema = StructType([StructField("id", StringType(), False), StructField("v", StringType())])
    (expectation,) = not_null_expectations(schema)
    assert expectation.name == "valid_id" and expectation.drop
    assert apply_expectations(rows, [expectation]).count() == 3
