"""The tabular layers: raw feeds to Bronze, Bronze to the common model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from layerworks.config import build_schema_from_yaml, section
from layerworks.operators.quality import (
    Expectation,
    expect,
    expect_or_drop,
    ingest_metrics,
    malformed,
    required_column,
    well_formed,
)
from layerworks.operators.rules import CDM_COLUMNS, to_common_model, union_clients
from layerworks.plans.datasets import Dataset, materialized_view
from layerworks.plans.tables import overwrite_table
from layerworks.sources.records import read_bronze

# Names and predicates of the expectations on the common model.
VALID_ID = expect_or_drop("valid_employee_id", "employee_id IS NOT NULL")
HAS_SALARY = expect("has_base_salary", "base_salary IS NOT NULL")
HAS_JOIN_DATE = expect("has_join_date", "join_date IS NOT NULL")


def ingest_to_bronze(spark: SparkSession, config: Mapping[str, Any], table: str) -> DataFrame:
    """Write one client's raw records, and give the counts of the written table."""
    return ingest_metrics(overwrite_table(read_bronze(spark, config), table))


def clean_bronze(spark: SparkSession, table: str) -> DataFrame:
    """The records of a Bronze table that fitted their schema."""
    return well_formed(spark.table(table))


def build_common_model(
    spark: SparkSession, clients: Iterable[tuple[Mapping[str, Any], str]], table: str
) -> DataFrame:
    """Union the clients' Bronze tables into the common model and write it."""
    models = [to_common_model(clean_bronze(spark, bronze), config) for config, bronze in clients]
    return overwrite_table(union_clients(models), table)


def feed_expectations(config: Mapping[str, Any]) -> list[Expectation]:
    """Expectations for a client: columns its schema declares not nullable have a value, under
    their names in the common model; a date that has to be parsed may be missing."""
    names = config.get("column_mapping") or {}
    declared = [field.name for field in build_schema_from_yaml(config).fields if not field.nullable]
    required = [names.get(name, name) for name in declared]
    more = [required_column(name) for name in required if name in CDM_COLUMNS and name != "employee_id"]
    parsed = "join_date" in (config.get("transformations") or {})
    return [VALID_ID, *more, HAS_SALARY, *([HAS_JOIN_DATE] if parsed else [])]


def feed_datasets(
    configs: Iterable[Mapping[str, Any]], target: str = "silver_cdm", prefix: str = ""
) -> list[Dataset]:
    """Bronze, quarantine and Silver of every client, and their union, as declared datasets.

    ``prefix`` goes before every name, to choose a schema for instance.
    """
    datasets, models = [], []
    for config in configs:
        client, label = section(config, "client_id"), config.get("client_name", "")
        bronze, silver = f"{prefix}bronze_{client}", f"{prefix}silver_{client}"
        datasets += [
            _bronze_dataset(bronze, config, label),
            _quarantine_dataset(f"{prefix}quarantine_{client}", bronze, label),
            _silver_dataset(silver, bronze, config, label),
        ]
        models.append(silver)
    union = materialized_view(
        f"{prefix}{target}",
        lambda spark: union_clients([spark.table(model) for model in models]),
        "common model of all clients",
    )
    return [*datasets, union]


def _bronze_dataset(name: str, config: Mapping[str, Any], label: str) -> Dataset:
    return materialized_view(name, lambda spark: read_bronze(spark, config), f"{label} raw records")


def _quarantine_dataset(name: str, bronze: str, label: str) -> Dataset:
    return materialized_view(
        name, lambda spark: malformed(spark.table(bronze)), f"{label} records that do not fit"
    )


def _silver_dataset(name: str, bronze: str, config: Mapping[str, Any], label: str) -> Dataset:
    return materialized_view(
        name,
        lambda spark: to_common_model(clean_bronze(spark, bronze), config),
        f"{label} in the common model",
        feed_expectations(config),
    )
