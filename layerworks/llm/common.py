"""Shared by the operators of this folder: stored steps, columns by name, batches of bounded size."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.session import scratch_path

#: Words of the word-based operators: runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared scratch folder and read it back.

    The files outlive lost executors, cut the lineage, and let the shuffle files of the step go:
    Spark frees those when the driver's garbage collector finds their owners.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stored_at = path
    del df
    free_shuffles(spark)
    return kept


def release(*steps: DataFrame) -> None:
    """Empty the files of stored steps that nothing reads any more, also nothing planned."""
    for step in steps:
        # Not rows of Python: those would start more worker processes, which stay.
        none = step.sparkSession.range(0, 0, 1, 1).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in step.schema])
        none.write.mode("overwrite").parquet(step._stored_at)


def free_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner delete shuffle files that no DataFrame refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Caches of the operator that works in this process.
_CACHES: list = []


def forget_others(cache: Any) -> None:
    """Clear the caches of other operators in this process; called by a cached function as it makes something.

    Worker processes outlive a stage, and one after the other works for all operators; what an
    operator remembers, such as the ids of words, would else stay beside the memory of the next.
    """
    for other in _CACHES:
        if other is not cache:
            other.cache_clear()
    _CACHES[:] = [cache]


def words_of(text: Column) -> Column:
    """Array of words; a missing text has none."""
    found = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(found, lambda word: word != "")


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo: which share of the rows a document belongs to."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of a text column, one row at least."""
    return row_slices(batch, _lengths(batch.column(column)), limit)


def row_slices(batch: pa.RecordBatch, sizes: Sequence[float], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the sizes of a part's rows add up to about ``limit``, one row at least."""
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _lengths(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_pylist()
