"""Whole files as rows, in one batch or as an incremental stream."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.config import CORRUPT_COLUMN, INGEST_MODES

BATCH, INCREMENTAL = INGEST_MODES

# Columns of Spark's binary file source; a stream must be told them.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _given(**options: Any) -> dict[str, Any]:
    """The reader options that have a value."""
    return {name: value for name, value in options.items() if value}


def read_binary_batch(
    spark: SparkSession, source_path: str, path_glob_filter: str | None = None
) -> DataFrame:
    """All files of a folder; contents are read only if the column is used."""
    options = _given(pathGlobFilter=path_glob_filter)
    return spark.read.load(source_path, format="binaryFile", **options)


def read_binary_stream(
    spark: SparkSession,
    source_path: str,
    path_glob_filter: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The files of a folder as a stream: each run of it sees only new ones.

    ``max_files_per_trigger`` bounds a micro-batch when a backlog is large.
    """
    options = _given(pathGlobFilter=path_glob_filter, maxFilesPerTrigger=max_files_per_trigger)
    return spark.readStream.load(source_path, format="binaryFile", schema=FILE_SCHEMA, **options)


def read_binary(
    spark: SparkSession,
    source_path: str,
    mode: str = BATCH,
    path_glob_filter: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Read a folder in the mode its configuration names."""
    if mode == BATCH:
        return read_binary_batch(spark, source_path, path_glob_filter)
    if mode == INCREMENTAL:
        return read_binary_stream(spark, source_path, path_glob_filter, max_files_per_trigger)
    raise ValueError(f"unknown ingest mode {mode!r}; known modes: {', '.join(INGEST_MODES)}")


def to_bronze(files: DataFrame) -> DataFrame:
    """Document Bronze rows, the same for a batch and a stream."""
    return files.select(
        F.col("path").alias("file_path"),
        F.col("content").alias("binary_content"),
        F.current_timestamp().alias("ingest_timestamp"),
        F.lit(None).cast("string").alias(CORRUPT_COLUMN),
    )


def list_files(
    spark: SparkSession, source_path: str, path_glob_filter: str | None = None
) -> DataFrame:
    """Path, time of change and length of all files of a folder; no file is opened.

    As Spark's readers do, this passes over files without a byte.
    """
    return read_binary_batch(spark, source_path, path_glob_filter).select(
        F.col("path").alias("file_path"), F.col("modificationTime").alias("modified"), "length"
    )


def compare_listings(before: DataFrame, now: DataFrame) -> DataFrame:
    """Two listings by path: the columns of both, those of ``now`` first, and ``status``.

    ``status`` is ``added``, ``removed``, ``changed`` (another time or length) or ``same``.  The
    time and length are those of ``now``, or of a removed file's last listing.
    """
    kept = [c for c in before.columns if c not in ("file_path", "modified", "length")]
    old, new = F.col("old"), F.col("new")
    joined = before.select("file_path", F.struct(*before.columns).alias("old")).join(
        now.select("file_path", F.struct(*now.columns).alias("new")), "file_path", "full"
    )
    differs = (old["modified"] != new["modified"]) | (old["length"] != new["length"])
    status = F.when(old.isNull(), "added").when(new.isNull(), "removed").when(differs, "changed")
    return joined.select(
        "file_path",
        F.coalesce(new["modified"], old["modified"]).alias("modified"),
        F.coalesce(new["length"], old["length"]).alias("length"),
        *[old[c].alias(c) for c in kept],
        status.otherwise("same").alias("status"),
    )


def _only_listed(files: DataFrame, listed: DataFrame) -> DataFrame:
    oldest = listed.agg(F.min("modified")).first()[0]
    if oldest is None:
        return files.limit(0)
    files = files.where(F.col("modificationTime") >= F.lit(oldest))
    named = listed.select(F.col("file_path").alias("path"))
    others = files.select("path").join(named, "path", "left_anti")
    return files if others.isEmpty() else files.join(others, "path", "left_anti")


def read_listed(
    spark: SparkSession,
    source_path: str,
    listed: DataFrame,
    path_glob_filter: str | None = None,
    only: Column | None = None,
) -> DataFrame:
    """The listed files of a folder with their contents.

    Files older than all listed ones are not opened: the reader is told the oldest time.  Those that
    are as new without being listed are few, mostly none, and are left out by an anti join; so
    contents need no shuffle, however many files are listed.  ``only`` is a condition on a file's
    ``_metadata``; files that fail it are not opened either.
    """
    files = read_binary_batch(spark, source_path, path_glob_filter)
    return _only_listed(files if only is None else files.where(only), listed)


def read_listed_lines(
    spark: SparkSession,
    source_path: str,
    listed: DataFrame,
    path_glob_filter: str | None = None,
    only: Column | None = None,
) -> DataFrame:
    """The listed files by lines that end with a line feed, however long the files are.

    Lines have the path and length of their file; ``start`` and ``number`` order those of a file.
    """
    files = read_binary_batch(spark, source_path, path_glob_filter)
    lines = spark.read.load(source_path, format="text", lineSep="\n", **_given(pathGlobFilter=path_glob_filter))
    if only is not None:
        files, lines = files.where(only), lines.where(only)
    name = F.col("_metadata.file_path").alias("name")
    named = _only_listed(files.select("path", "modificationTime", "length", name), listed).select("path", "length", "name")
    lines = lines.select(
        name,
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"),
        "value",
    )
    return lines.join(F.broadcast(named), "name").drop("name")
