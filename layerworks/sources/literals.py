"""Rows given in the program."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_rows(
    spark: SparkSession, rows: Sequence[Sequence[Any]], names: Sequence[str]
) -> DataFrame:
    """Literal rows as a table whose size the planner knows.

    Handed over as Arrow they become a local relation, so that a join with them
    can be planned as a broadcast; rows handed over as tuples have no known size.
    """
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True))))
