"""Configured column rules, and the common data model they lead to."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.config import ConfigError, department_scope, role_names, section
from layerworks.functions.ids import lookup
from layerworks.operators.dictionaries import replaced

# Columns of the common data model, in order.
CDM_COLUMNS = (
    "employee_id",
    "base_salary",
    "department",
    "join_date",
    "allowed_roles",
    "source_client",
    "_transformed_at",
)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in one projection; names the data lacks are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def strip_chars(value: Column, chars: str) -> Column:
    """Delete every character of a set."""
    return F.translate(value, chars, "")


def cast(value: Column, type_name: str) -> Column:
    """Convert; what does not convert is null."""
    return value.try_cast(type_name)


def date_format(value: Column, pattern: str) -> Column:
    """Parse a date by a pattern; what does not parse is null."""
    return F.try_to_date(value, pattern)


def map_values(value: Column, entries: Mapping[Any, Any]) -> Column:
    """Replace values by a dictionary; others, and null, stay."""
    return F.coalesce(lookup(value, entries), value)


# Rule name in a configuration -> expression.
RULES: dict[str, Callable[[Column, Any], Column]] = {
    "strip_chars": strip_chars,
    "cast": cast,
    "date_format": date_format,
    "mapping": map_values,
}

# Rules that make null of values they cannot convert.
REJECTING = ("cast", "date_format")


def _steps(rules: Any) -> list[tuple[str, Any]]:
    """A column's rules in order: given as one mapping, or a list of mappings."""
    groups = [rules] if isinstance(rules, Mapping) else list(rules)
    steps = [step for group in groups for step in group.items()]
    unknown = sorted({name for name, _ in steps} - RULES.keys())
    if unknown:
        raise ConfigError(f"unknown rules: {', '.join(unknown)}; known: {', '.join(RULES)}")
    return steps


def _typed_mapping(df: DataFrame, column: str, value: Column, entries: Mapping[Any, Any]) -> Column:
    """``map_values`` whose result has the column's type, whatever the size of the dictionary."""
    kind = df.select(value.alias("value")).schema["value"].dataType
    return replaced(value, entries, kind, column)


def _applied(df: DataFrame, column: str, rules: Any) -> list[tuple[str, Column, Column]]:
    """Name, input and output of each of a column's rules."""
    value, applied = F.col(f"`{column}`"), []
    for name, argument in _steps(rules):
        before = value
        if name == "mapping":
            value = _typed_mapping(df, column, value, argument)
        else:
            value = RULES[name](value, argument)
        applied.append((name, before, value))
    return applied


def apply_rules(df: DataFrame, transformations: Mapping[str, Any] | None) -> DataFrame:
    """Apply each column's rules in the order given, all in one projection."""
    for column, rules in (transformations or {}).items():
        for _, _, value in _applied(df, column, rules)[-1:]:
            df = df.withColumn(column, value)
    return df


def rejected_values(
    df: DataFrame, transformations: Mapping[str, Any] | None, *keys: str
) -> DataFrame:
    """The values that ``apply_rules`` turns into null: keys, column, rule and the value as it came.

    A missing value is not a rejected one.  One pass, no shuffle.
    """
    rejected = F.array().cast("array<struct<column: string, rule: string, raw: string>>")
    for column, rules in (transformations or {}).items():
        raw = F.col(f"`{column}`").cast("string")
        for name, before, after in _applied(df, column, rules):
            found = F.struct(F.lit(column).alias("column"), F.lit(name).alias("rule"), raw.alias("raw"))
            none = before.isNotNull() & after.isNull()
            if name in REJECTING:
                rejected = F.concat(rejected, F.when(none, F.array(found)).otherwise(F.array()))
    return df.select(*keys, F.inline(rejected))


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Rejected values by column and rule."""
    return rejected.groupBy("column", "rule").agg(F.count("*").alias("n_rejected"))


def add_cdm_metadata(
    df: DataFrame, config: Mapping[str, Any], columns: Iterable[str] = CDM_COLUMNS
) -> DataFrame:
    """Add roles, client and time, and keep the columns of the common model.

    The department is that of the row, the only scope there is (``from_data``).
    """
    permissions = section(config, "permission_metadata")
    department_scope(permissions)
    section(permissions, "allowed_roles")
    return df.withColumns(
        {
            "allowed_roles": F.lit(role_names(permissions)),
            "source_client": F.lit(section(config, "client_id")),
            "_transformed_at": F.current_timestamp(),
        }
    ).select(*columns)


def to_common_model(
    clean: DataFrame, config: Mapping[str, Any], columns: Iterable[str] = CDM_COLUMNS
) -> DataFrame:
    """One client's well-formed records in the common model, by its configuration alone."""
    renamed = rename_columns(clean, section(config, "column_mapping"))
    return add_cdm_metadata(apply_rules(renamed, config.get("transformations")), config, columns)


def union_clients(clients: Iterable[DataFrame]) -> DataFrame:
    """All clients' rows, matched by column name."""
    return reduce(DataFrame.unionByName, clients)
