"""Exact deduplication of documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.operators.newest import first_per_key


def dedup_documents(
    df: DataFrame,
    key_col: str = "extracted_text",
    order_by: Sequence[str] = ("document_id",),
) -> DataFrame:
    """One row per distinct text, that with the smallest id; null is one text.

    Rows are told apart by a SHA-256 of the text, kept as 32 bytes.  Copies are
    merged before the shuffle, so even a text that makes up a third of the
    collection leaves each task once, and the text is read and prepared once.
    """
    digest = F.unhex(F.sha2(F.col(f"`{key_col}`").cast("binary"), 256))
    return first_per_key(df, digest, order_by)
