"""Text of documents: extraction by type, cleaning, masking, and the Silver rows.

Markdown is decoded, cleaned and masked by Column expressions.  Other types need a
parser for their file format; a caller plugs in ``{type: function(bytes) -> str}``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from importlib import import_module

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.config import CORRUPT_COLUMN
from layerworks.functions.ids import SOURCE_TYPES, document_id, source_type
from layerworks.functions.text import clean_text, decode_utf8, redact_pii
from layerworks.operators.dedup import dedup_documents

# Executors need not have this package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(import_module("layerworks"))

Parser = Callable[[bytes], str]

# The type whose files are text already.
TEXT_TYPE = "md"

# Characters of text that a parser slot holds before it gives them back, and one text more.
PART_CHARS = 1 << 20

_PARSED = pa.struct([("text", pa.string()), ("error", pa.string())])


def join_parts(parts: Sequence[str | None], keep_empty: bool = False) -> str:
    """Text of pages or slides, parted by blank lines.

    Parsers of slides leave empty shapes out; those of pages keep empty pages.
    """
    texts = [part or "" for part in parts]
    return "\n\n".join(text for text in texts if text or keep_empty)


def _parsed(parsers: Mapping[str, Parser], content: Column, kind: Column) -> Column:
    """Struct of text and error from the parser of a row's type; nulls for null content."""

    def parse_one(data: bytes | None, name: str | None) -> tuple[str | None, str | None]:
        if data is None:
            return None, None
        try:
            text = parsers[name](bytes(data)) or ""
            # Arrow takes no lone surrogates, which some parsers let through.
            return text.encode("utf-8", "replace").decode("utf-8"), None
        except Exception as error:  # noqa: BLE001 - any failure quarantines the document
            return None, f"{type(error).__name__}: {error}"

    # Texts go back in small parts: of a batch of files only the contents are held whole.
    @F.arrow_udf("text string, error string")
    def parse(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for contents, kinds in batches:
            found, held = [], 0
            for data, name in zip(contents, kinds, strict=True):
                text, error = parse_one(data.as_py(), name.as_py())
                found.append({"text": text, "error": error})
                held += len(text or "")
                if held >= PART_CHARS:
                    yield pa.array(found, _PARSED)
                    found, held = [], 0
            if found:
                yield pa.array(found, _PARSED)

    return parse(content, kind)


def add_extracted_text(
    documents: DataFrame,
    parsers: Mapping[str, Parser] | None = None,
    types: Mapping[str, str] = SOURCE_TYPES,
) -> DataFrame:
    """Bronze documents with type, text, and the reason why there is no text.

    Only the contents of types with a parser are handed to Python; without parsers
    the plan has no Python step at all.
    """
    parsers = dict(parsers or {})
    kind, content = F.col("source_type"), F.col("binary_content")
    documents = documents.withColumn("source_type", source_type("file_path", types))
    is_text = (kind == TEXT_TYPE) if TEXT_TYPE not in parsers else F.lit(False)
    has_text = is_text & content.isNotNull()
    raw = decode_utf8(content)
    reason = (
        F.when(kind.isNull(), "unsupported_type")
        .when(content.isNull(), "null_content")
        .when(is_text, F.lit(None))
    )
    if parsers:
        has_parser = kind.isin(list(parsers))
        documents = documents.withColumn(
            "_parsed", _parsed(parsers, F.when(has_parser, content), kind)
        )
        parsed, error = F.col("_parsed.text"), F.col("_parsed.error")
        has_text = has_text | (has_parser & parsed.isNotNull())
        raw = F.when(has_parser, parsed).otherwise(raw)
        reason = reason.when(
            has_parser, F.when(error.isNotNull(), F.concat(F.lit("parse_error:"), error))
        )
    reason = reason.otherwise(F.concat(F.lit("no_parser:"), kind))
    if CORRUPT_COLUMN in documents.columns:
        reason = F.coalesce(F.col(CORRUPT_COLUMN), reason)
    # An empty file has a text, the empty one; a failure has none.  As the masked
    # text is never null itself, a later test for a missing text reduces to
    # ``has_text``: the optimiser need not clean and mask to evaluate it.
    text = F.when(has_text, F.coalesce(redact_pii(clean_text(raw)), F.lit("")))
    return documents.withColumns({"extracted_text": text, CORRUPT_COLUMN: reason}).drop("_parsed")


def quarantined_documents(extracted: DataFrame) -> DataFrame:
    """The documents without a text, and why."""
    return extracted.where(F.col("extracted_text").isNull()).select(
        "file_path", "source_type", CORRUPT_COLUMN
    )


def to_silver(extracted: DataFrame) -> DataFrame:
    """One row per distinct text, with its id, type and origin."""
    prepared = (
        extracted.where(F.col("extracted_text").isNotNull())
        # The file contents end here: they must not travel through the shuffle.
        .select(
            document_id("file_path").alias("document_id"),
            "extracted_text",
            "source_type",
            "file_path",
            "ingest_timestamp",
        )
    )
    return silver_rows(dedup_documents(prepared))


def silver_rows(documents: DataFrame, *others: str) -> DataFrame:
    """The columns of Silver and ``others``, for documents that are told apart already."""
    return documents.select(
        "document_id",
        "extracted_text",
        "source_type",
        F.create_map(
            F.lit("file_path"),
            F.col("file_path"),
            F.lit("ingest_timestamp"),
            F.col("ingest_timestamp").cast("string"),
        ).alias("metadata"),
        *others,
    )
