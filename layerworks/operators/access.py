"""Access attributes on rows, and reading through them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.config import access_attributes


def attach_access(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """Give every row the configured roles and department."""
    return df.withColumns(
        {name: F.lit(value) for name, value in access_attributes(config).items()}
    )


def may_read(roles: Iterable[str], allowed: Column | None = None) -> Column:
    """Whether a row allows one of the caller's roles; names are compared whole."""
    roles = list(roles)
    if not roles:
        return F.lit(False)
    allowed = F.col("allowed_roles") if allowed is None else allowed
    return F.arrays_overlap(F.split(allowed, ","), F.array(*map(F.lit, roles)))


def visible_rows(df: DataFrame, roles: Iterable[str], department: str | None = None) -> DataFrame:
    """The rows a caller may read, of one department if given."""
    readable = df.where(may_read(roles))
    return readable if department is None else readable.where(F.col("department") == department)


def secured(
    df: DataFrame, roles: Iterable[str], department: str, masked: Iterable[str]
) -> DataFrame:
    """Hide rows the caller's roles do not cover; mask columns of other departments' rows."""
    own = F.col("department") == department
    return visible_rows(df, roles).withColumns(
        {name: F.when(own, F.col(f"`{name}`")) for name in masked}
    )


def create_secure_view(
    df: DataFrame, name: str, roles: Iterable[str], department: str, masked: Iterable[str]
) -> None:
    """Register ``secured`` rows as a view, to be read in place of the table."""
    secured(df, roles, department, masked).createOrReplaceTempView(name)
