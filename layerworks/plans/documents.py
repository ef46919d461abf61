"""The document layers: files to Bronze, text to Silver, chunks to Gold."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from layerworks.config import section
from layerworks.functions.ids import SOURCE_TYPES
from layerworks.operators.chunk import to_gold_chunks
from layerworks.operators.extract import (
    Parser,
    add_extracted_text,
    quarantined_documents,
    to_silver,
)
from layerworks.operators.quality import expect_or_drop
from layerworks.plans.datasets import Dataset, materialized_view, streaming_table
from layerworks.plans.tables import append_stream, overwrite_table
from layerworks.sources.files import BATCH, INCREMENTAL, read_binary, to_bronze

# Name and predicate of the expectation on document text.
HAS_TEXT = expect_or_drop("has_extracted_text", "extracted_text IS NOT NULL")

#: Tables of ``document_datasets``, in order.
DOCUMENT_TABLES = ("bronze_docs", "extracted_docs", "quarantined_docs", "silver_docs", "gold_chunks")


def bronze_documents(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """The configured folder's files as Bronze rows, batch or stream by its mode."""
    source = section(config, "source")
    files = read_binary(
        spark,
        section(source, "path"),
        source.get("mode") or BATCH,
        source.get("path_glob_filter"),
        source.get("max_files_per_trigger"),
    )
    return to_bronze(files)


def ingest_documents(
    spark: SparkSession, config: Mapping[str, Any], table: str, checkpoint: str | None = None
) -> DataFrame:
    """Write Bronze: replaced by a batch, appended to by a stream."""
    bronze = bronze_documents(spark, config)
    if not bronze.isStreaming:
        return overwrite_table(bronze, table)
    if checkpoint is None:
        raise ValueError(f"mode {INCREMENTAL!r} needs a checkpoint")
    append_stream(bronze, table, checkpoint)
    return spark.table(table)


def silver_documents(
    bronze: DataFrame,
    parsers: Mapping[str, Parser] | None = None,
    types: Mapping[str, str] = SOURCE_TYPES,
) -> DataFrame:
    """Extracted, cleaned, masked and deduplicated documents."""
    return to_silver(add_extracted_text(bronze, parsers, types))


def document_datasets(
    config: Mapping[str, Any],
    checkpoint: str | None = None,
    parsers: Mapping[str, Parser] | None = None,
    types: Mapping[str, str] = SOURCE_TYPES,
    prefix: str = "",
) -> list[Dataset]:
    """The layers as declared datasets: Bronze, extracted texts, quarantine, Silver, Gold.

    Bronze and the extracted texts follow the ingest mode: a stream extracts each file
    once, when it is new.  So after a change of parsers both need a new checkpoint and
    new tables.  Silver and the quarantine read the same extraction.

    ``prefix`` goes before every name, to choose a schema for instance.
    """
    mode = section(config, "source").get("mode") or BATCH
    comment, text_comment = f"raw document files ({mode})", f"text of every file, or why none ({mode})"
    names = [f"{prefix}{name}" for name in DOCUMENT_TABLES]
    bronze_name, text_name, quarantine_name, silver_name, gold_name = names

    def build(spark: SparkSession) -> DataFrame:
        return bronze_documents(spark, config)

    def extracted(bronze: DataFrame) -> DataFrame:
        return add_extracted_text(bronze, parsers, types).drop("binary_content")

    if mode == INCREMENTAL:
        if checkpoint is None:
            raise ValueError(f"mode {INCREMENTAL!r} needs a checkpoint")
        sources = [
            streaming_table(bronze_name, build, checkpoint, comment),
            streaming_table(
                text_name,
                lambda spark: extracted(spark.readStream.table(bronze_name)),
                f"{checkpoint.rstrip('/')}_extracted",
                text_comment,
            ),
        ]
    else:
        sources = [
            materialized_view(bronze_name, build, comment),
            materialized_view(
                text_name, lambda spark: extracted(spark.table(bronze_name)), text_comment
            ),
        ]
    return [
        *sources,
        materialized_view(
            quarantine_name,
            lambda spark: quarantined_documents(spark.table(text_name)),
            "documents without a text, and why",
        ),
        materialized_view(
            silver_name,
            lambda spark: spark.table(text_name),
            "document text, cleaned and masked",
            [HAS_TEXT],
            finish=to_silver,
        ),
        materialized_view(
            gold_name,
            lambda spark: to_gold_chunks(spark.table(silver_name), config),
            "document chunks with access attributes",
        ),
    ]
