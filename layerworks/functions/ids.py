"""Stable identifiers and the document type, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerworks.functions.columns import as_column

# File extension -> document type.
SOURCE_TYPES = {
    ".pdf": "pdf",
    ".pptx": "pptx",
    ".ppt": "pptx",
    ".md": "md",
    ".markdown": "md",
}

ID_LENGTH = 32


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, ID_LENGTH)


def document_id(file_path: Column | str) -> Column:
    """The same path always gives the same id, so re-ingested files can be upserted."""
    return _digest(as_column(file_path))


def chunk_id(document: Column | str, index: Column | str) -> Column:
    """Id of a chunk, from its document's id and its position."""
    return _digest(F.concat(as_column(document), F.lit(":"), as_column(index).cast("string")))


def lookup(key: Column, entries: Mapping[str, str]) -> Column:
    """Value of ``key`` in a small dictionary, null if it has none."""
    if not entries:
        return F.lit(None).cast("string")
    pairs = [F.lit(item) for entry in entries.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), key)


def source_type(file_path: Column | str, types: Mapping[str, str] = SOURCE_TYPES) -> Column:
    """Document type from the last extension, whatever its case; null if unknown.

    A file name of which only leading dots precede the rest (``.md``) has no extension.
    """
    file_name = F.substring_index(as_column(file_path), "/", -1)
    extension = F.regexp_extract(file_name, "(?s)\\A\\.*[^.].*(\\.[^.]*)\\z", 1)
    return lookup(F.lower(extension), types)
