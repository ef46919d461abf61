"""Small helpers for building Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    """A Column as it is, a name as the column of that name."""
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]
