"""Configuration of feeds and document collections: parsing, schema, lookups.

A configuration is a small dictionary on the driver, usually read from YAML.
"""

from __future__ import annotations

import copy
from collections.abc import Mapping
from typing import Any

import yaml
from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: the column that holds the raw text, or the reason, of a bad record.
CORRUPT_COLUMN = "_corrupt"

# How a document is chunked if its configuration says nothing.
DEFAULT_STRATEGY = {"strategy": "paragraph", "max_chars": 1000, "overlap": 100}


# The ways to chunk, where a department comes from, and the ingest modes.
STRATEGIES = ("paragraph", "markdown_header")
DEPARTMENT_SCOPES = ("from_data",)
INGEST_MODES = ("batch", "autoloader")


class ConfigError(ValueError):
    """A configuration lacks a section, or holds a value of the wrong kind."""


def parse_yaml_config(content: str) -> dict[str, Any]:
    """Configuration text to a dictionary."""
    config = yaml.safe_load(content)
    if config is not None and not isinstance(config, dict):
        raise ConfigError(f"a configuration must be a mapping, not {type(config).__name__}")
    return config or {}


def load_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read one configuration file from any file system Spark can reach."""
    row = spark.read.text(path, wholetext=True).first()
    return parse_yaml_config(row.value if row else "")


def load_client_config(spark: SparkSession, folder: str, client_id: str) -> dict[str, Any]:
    """Configuration of one client, kept as ``<folder>/<client id>.yaml`` and checked."""
    return check_client_config(load_config(spark, f"{folder.rstrip('/')}/{client_id}.yaml"))


def load_parsing_config(spark: SparkSession, folder: str) -> dict[str, Any]:
    """Configuration of the document collection, kept as ``<folder>/parsing.yaml`` and checked."""
    return check_parsing_config(load_config(spark, f"{folder.rstrip('/')}/parsing.yaml"))


def section(config: Mapping[str, Any], name: str) -> Any:
    """A required section of a configuration."""
    if name not in config:
        raise ConfigError(f"configuration has no section {name!r}")
    return config[name]


def build_schema_from_yaml(config: Mapping[str, Any]) -> StructType:
    """Schema declared in the configuration, with the column for bad records added."""
    declared = StructType.fromJson(copy.deepcopy(section(config, "schema")))
    corrupt = StructField(
        CORRUPT_COLUMN, StringType(), True, {"comment": "raw text of records that do not fit"}
    )
    return StructType([*declared.fields, corrupt])


def _checked_strategy(name: str, strategy: Any) -> dict[str, Any]:
    """A strategy as configured, if it can be followed."""
    if not isinstance(strategy, Mapping):
        raise ConfigError(f"chunking of {name} must be a mapping, not {strategy!r}")
    kind = strategy.get("strategy", DEFAULT_STRATEGY["strategy"])
    if kind not in STRATEGIES:
        raise ConfigError(f"chunking of {name}: unknown strategy {kind!r}; known: {', '.join(STRATEGIES)}")
    for key, least in (("max_chars", 1), ("overlap", 0)):
        size = strategy.get(key, DEFAULT_STRATEGY[key])
        if isinstance(size, bool) or not isinstance(size, int) or size < least:
            raise ConfigError(f"chunking of {name}: {key} must be a whole number from {least} on, not {size!r}")
    if {"max_chars", "overlap"} <= strategy.keys() and strategy["overlap"] >= strategy["max_chars"]:
        raise ConfigError(f"chunking of {name}: overlap must be below max_chars")
    return dict(strategy)


def strategy_table(config: Mapping[str, Any]) -> dict[str | None, dict[str, Any]]:
    """The strategy of every configured type, all checked; ``None`` has that of all other types."""
    given = config.get("chunking") or {}
    table = {name: _checked_strategy(name, strategy) for name, strategy in given.items() if strategy not in (None, {})}
    rest = table.pop("default", None)
    return {**table, None: DEFAULT_STRATEGY if rest is None else rest}


def chunk_strategy(source_type: str | None, config: Mapping[str, Any]) -> dict[str, Any]:
    """Strategy of a document type."""
    table = strategy_table(config)
    return dict(table[source_type if source_type in table else None])


def department_scope(permissions: Mapping[str, Any]) -> str:
    """Where a row's department comes from."""
    scope = permissions.get("department_scope", DEPARTMENT_SCOPES[0])
    if scope not in DEPARTMENT_SCOPES:
        raise ConfigError(f"unknown department_scope {scope!r}; known: {', '.join(DEPARTMENT_SCOPES)}")
    return scope


def check_client_config(config: Mapping[str, Any]) -> dict[str, Any]:
    """A client's configuration, if a feed can follow it."""
    for name in ("client_id", "source", "schema"):
        section(config, name)
    build_schema_from_yaml(config)
    permissions = config.get("permission_metadata") or {}
    role_names(permissions)
    department_scope(permissions)
    return dict(config)


def check_parsing_config(config: Mapping[str, Any]) -> dict[str, Any]:
    """A document collection's configuration, if its layers can follow it."""
    source = section(config, "source")
    mode = source.get("mode") or INGEST_MODES[0]
    if mode not in INGEST_MODES:
        raise ConfigError(f"unknown ingest mode {mode!r}; known: {', '.join(INGEST_MODES)}")
    strategy_table(config)
    role_names(config.get("permission_metadata") or {})
    return dict(config)


def role_names(permissions: Mapping[str, Any]) -> str:
    """Configured roles joined by commas; one word, or a name with a comma, is no list of roles."""
    roles = permissions.get("allowed_roles") or []
    if not isinstance(roles, (list, tuple)) or not all(isinstance(role, str) for role in roles):
        raise ConfigError(f"allowed_roles must be a list of names, not {roles!r}")
    if any("," in role for role in roles):
        raise ConfigError("a role name cannot hold a comma")
    return ",".join(roles)


def access_attributes(config: Mapping[str, Any]) -> dict[str, str]:
    """Roles (joined by commas) and department; what is not configured is empty."""
    permissions = config.get("permission_metadata") or {}
    return {
        "allowed_roles": role_names(permissions),
        "department": permissions.get("department") or "",
    }
