"""Filters, derived columns, joins and summaries over a fact table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_least(df: DataFrame, columns: Sequence[str], column: str, minimum: Any) -> DataFrame:
    """Some columns of the rows whose ``column`` is ``minimum`` or more."""
    return df.select(*columns).where(F.col(column) >= minimum)


def in_thousands(amount: Column) -> Column:
    """An amount in thousands, without decimals."""
    return F.round(amount / 1000, 0)


def band(value: Column, bands: Sequence[tuple[Any, str]], rest: str) -> Column:
    """Label of the first band whose upper bound, itself excluded, is above the value."""
    (bound, label), *others = bands
    chain = F.when(value < bound, F.lit(label))
    for bound, label in others:
        chain = chain.when(value < bound, F.lit(label))
    return chain.otherwise(F.lit(rest))


def summarize(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Rows, rounded mean and maximum of an amount by key, the highest mean first."""
    return (
        df.groupBy(key)
        .agg(
            F.count("*").alias("headcount"),
            F.round(F.avg(amount), 0).alias("avg_amount"),
            F.max(amount).alias("max_amount"),
        )
        .orderBy(F.desc("avg_amount"))
    )


def summarize_sql(df: DataFrame, key: str, amount: str, view: str) -> DataFrame:
    """The same summary in SQL over a temporary view."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(
        f"""
        SELECT {key}, count(*) AS headcount, round(avg({amount}), 0) AS avg_amount,
               max({amount}) AS max_amount
        FROM {view} GROUP BY {key} ORDER BY avg_amount DESC
        """
    )


def with_dimension(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows with their dimension's columns; the key appears once.

    There is no hint: the optimiser broadcasts a dimension whose size allows it.
    """
    return df.join(dimension, on=key, how="inner")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by keys, in key order."""
    return df.groupBy(*keys).count().orderBy(*keys)


def first_by(df: DataFrame, columns: Sequence[str], order_by: Sequence[Column], count: int) -> DataFrame:
    """A report of the first rows in an order, whose columns need not be shown.

    Spark keeps ``count`` rows of each task, so only those meet in one.
    """
    return df.orderBy(*order_by).limit(count).select(*columns)
