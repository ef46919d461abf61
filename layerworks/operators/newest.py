"""Keeping one row per key without gathering the rows of a key.

``min_by`` and ``max_by`` are partially aggregated before the shuffle, so a key
with a third of all rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def first_per_key(df: DataFrame, key: Column, order_by: Sequence[str]) -> DataFrame:
    """Of the rows with the same key (null is a key too), the one that sorts first."""
    return (
        df.groupBy(key.alias("_key"))
        .agg(F.min_by(F.struct(*_columns(df.columns)), F.struct(*_columns(order_by))).alias("_row"))
        .select("_row.*")
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Of the rows with the same key, the one that sorts last."""
    return (
        df.groupBy(*[column.alias(f"_key_{i}") for i, column in enumerate(_columns(keys))])
        .agg(F.max_by(F.struct(*_columns(df.columns)), F.struct(*_columns(order_by))).alias("_row"))
        .select("_row.*")
    )
