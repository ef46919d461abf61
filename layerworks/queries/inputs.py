"""Reading the test tables, and writing throw-away tables for queries about writing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from layerworks.plans.tables import drop_table

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fresh_name(label: str) -> str:
    """A table name no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"


def detach(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table kept at a path of its own, without leaving its name behind."""
    rows = spark.table(name)
    drop_table(spark, name)
    return rows
