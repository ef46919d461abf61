"""Expectations on rows, quarantine of bad records, and run metrics."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerworks.config import CORRUPT_COLUMN


@dataclass(frozen=True)
class Expectation:
    """A named predicate in SQL; failing rows are counted, and dropped if ``drop``."""

    name: str
    predicate: str
    drop: bool = False

    @property
    def holds(self) -> Column:
        """True or false, never null: an unknown answer is a failure."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Expectation:
    """Keep every row and count those that fail."""
    return Expectation(name, predicate)


def expect_or_drop(name: str, predicate: str) -> Expectation:
    """Drop and count the rows that fail."""
    return Expectation(name, predicate, drop=True)


def not_null_expectations(schema: StructType) -> list[Expectation]:
    """Expectations for the columns declared not nullable, which file readers let pass."""
    return [required_column(field.name) for field in schema.fields if not field.nullable]


def required_column(name: str) -> Expectation:
    """Rows without a value of the column are dropped."""
    return expect_or_drop(f"valid_{name}", f"`{name}` IS NOT NULL")


def drop_failing(df: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    """The rows that pass every dropping expectation."""
    required = [expectation.holds for expectation in expectations if expectation.drop]
    return df.where(reduce(and_, required)) if required else df


def apply_expectations(
    df: DataFrame, expectations: Iterable[Expectation], observation: Observation | str | None = None
) -> DataFrame:
    """Count failures of every expectation while the result is written, then drop.

    All predicates see the same rows, those before any is dropped.  The counts
    cost no extra pass; ``observation.get`` has them once the write is done.  A stream
    takes a name instead, under which its progress has the counts of each micro-batch.
    """
    expectations = list(expectations)
    if observation is not None:
        counters = [F.count("*").alias("rows")] + [
            F.count_if(~expectation.holds).alias(expectation.name) for expectation in expectations
        ]
        df = df.observe(observation, *counters)
    return drop_failing(df, expectations)


def expectation_metrics(df: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    """One row per expectation with the rows that pass and fail, in one pass over the data."""
    expectations = list(expectations)
    total = F.count("*").alias("total")
    failed = [
        F.count_if(~expectation.holds).alias(f"failed_{i}")
        for i, expectation in enumerate(expectations)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(expectation.name).alias("expectation"),
                F.lit("drop" if expectation.drop else "warn").alias("action"),
                (F.col("total") - F.col(f"failed_{i}")).alias("passed"),
                F.col(f"failed_{i}").alias("failed"),
            )
            for i, expectation in enumerate(expectations)
        ]
    )
    return df.agg(total, *failed).select(F.inline(rows))


def well_formed(df: DataFrame) -> DataFrame:
    """Records that fitted their schema."""
    return df.where(F.col(CORRUPT_COLUMN).isNull())


def malformed(df: DataFrame) -> DataFrame:
    """Records kept for inspection: the quarantine."""
    return df.where(F.col(CORRUPT_COLUMN).isNotNull())


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed and malformed records of a written table."""
    return well_formed(df), malformed(df)


def ingest_metrics(df: DataFrame) -> DataFrame:
    """Total, good and corrupt records of a written table, in one pass."""
    corrupt = F.col(CORRUPT_COLUMN).isNotNull()
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(~corrupt).alias("good"),
        F.count_if(corrupt).alias("corrupt"),
    )
