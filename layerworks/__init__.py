"""Layered data preparation on Spark: configured feeds and document collections."""

from layerworks.config import (
    build_schema_from_yaml,
    check_client_config,
    check_parsing_config,
    chunk_strategy,
    load_client_config,
    load_config,
    load_parsing_config,
    parse_yaml_config,
)
from layerworks.functions.ids import chunk_id, document_id, source_type
from layerworks.functions.text import clean_text, decode_utf8, redact_pii, strip
from layerworks.operators.access import attach_access, create_secure_view, secured, visible_rows
from layerworks.operators.chunk import (
    chunk_text,
    chunkless_documents,
    heading_chunks,
    paragraph_chunks,
    to_gold_chunks,
)
from layerworks.operators.dedup import dedup_documents
from layerworks.operators.extract import add_extracted_text, quarantined_documents, to_silver
from layerworks.operators.newest import newest_per_key
from layerworks.operators.quality import (
    apply_expectations,
    expect,
    expect_or_drop,
    expectation_metrics,
    ingest_metrics,
    split_quarantine,
)
from layerworks.operators.rules import (
    add_cdm_metadata,
    apply_rules,
    rename_columns,
    to_common_model,
    union_clients,
)
from layerworks.operators.policies import create_policy_view
from layerworks.operators.upsert import upsert
from layerworks.plans.arrivals import DocumentCollection
from layerworks.plans.buckets import BucketedTable
from layerworks.plans.datasets import (
    Dataset,
    materialized_view,
    publish,
    publish_all,
    stream_counts,
    streaming_table,
)
from layerworks.plans.documents import document_datasets, ingest_documents, silver_documents
from layerworks.plans.feeds import build_common_model, feed_datasets, ingest_to_bronze
from layerworks.plans.tables import (
    VersionedTable,
    append_stream,
    append_table,
    drop_table,
    overwrite_table,
    publish_table,
)
from layerworks.sources.files import (
    compare_listings,
    list_files,
    read_binary,
    read_binary_batch,
    read_binary_stream,
    to_bronze,
)
from layerworks.sources.records import add_ingest_metadata, read_source
from layerworks.streaming.upsert import upsert_buckets, upsert_stream
