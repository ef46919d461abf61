"""Record files (CSV and the like) read under a configured schema."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerworks.config import CORRUPT_COLUMN, ConfigError, build_schema_from_yaml, section


def read_source(spark: SparkSession, source: Mapping[str, Any], schema: StructType) -> DataFrame:
    """Read what a ``source`` section names, keeping records that do not fit.

    Such a record keeps the fields that parsed, and its raw text in the column for
    bad records.  Count or filter that column on the written table: Spark refuses
    a query over raw CSV that uses nothing else.
    """
    missing = [key for key in ("file_format", "path") if key not in source]
    if missing:
        raise ConfigError(f"source lacks {', '.join(missing)}")
    options = {
        **(source.get("options") or {}),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    }
    return spark.read.schema(schema).load(
        source["path"], format=source["file_format"], **options
    )


def add_ingest_metadata(records: DataFrame, client_id: str) -> DataFrame:
    """Add when and from whom the records came."""
    return records.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_client": F.lit(client_id)}
    )


def read_bronze(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """The raw records of one client, malformed ones included."""
    records = read_source(spark, section(config, "source"), build_schema_from_yaml(config))
    return add_ingest_metadata(records, section(config, "client_id"))
