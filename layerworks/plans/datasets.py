"""Datasets declared by name, comment, expectations and the function that builds them.

The list is published in the order given; Spark plans and runs each dataset.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerworks.operators.quality import Expectation, apply_expectations
from layerworks.plans.tables import append_stream, publish_table


@dataclass(frozen=True)
class Dataset:
    """A table and how to fill it.

    With a ``checkpoint`` it is a streaming table: rows are appended, new ones only.
    Otherwise it is a materialised view: each run replaces it.

    Expectations see the rows that ``build`` gives; ``finish`` makes the table's rows
    from those that pass.
    """

    name: str
    build: Callable[[SparkSession], DataFrame]
    comment: str = ""
    expectations: Sequence[Expectation] = ()
    checkpoint: str | None = None
    finish: Callable[[DataFrame], DataFrame] | None = None


def materialized_view(
    name: str,
    build: Callable[[SparkSession], DataFrame],
    comment: str = "",
    expectations: Sequence[Expectation] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> Dataset:
    """A dataset that each run replaces."""
    return Dataset(name, build, comment, tuple(expectations), finish=finish)


def streaming_table(
    name: str,
    build: Callable[[SparkSession], DataFrame],
    checkpoint: str,
    comment: str = "",
    expectations: Sequence[Expectation] = (),
) -> Dataset:
    """A dataset that each run appends to."""
    return Dataset(name, build, comment, tuple(expectations), checkpoint)


def publish(spark: SparkSession, dataset: Dataset, folder: str | None = None) -> dict[str, int]:
    """Build and write one dataset; returns its row count and failures by expectation.

    With ``folder`` the table's files are kept there, else in the warehouse.

    A view is switched to the new rows when all are written, so a run that fails leaves the old
    ones.  A streaming table gives the counts of the micro-batches of this run, and keeps those of
    every micro-batch beside its checkpoint (``stream_counts``).
    """
    df = dataset.build(spark)
    path = f"{folder.rstrip('/')}/{dataset.name}" if folder else None
    streaming = dataset.checkpoint is not None
    observation = COUNTS if streaming else Observation()
    rows = apply_expectations(df, dataset.expectations, observation)
    if dataset.finish is not None:
        rows = dataset.finish(rows)
    if streaming:
        with _progress_kept(spark):
            query = append_stream(rows, dataset.name, dataset.checkpoint, path)
            return _keep_counts(spark, query, dataset)
    publish_table(rows, dataset.name, dataset.comment, folder.rstrip("/") if folder else None)
    return observation.get


def publish_all(
    spark: SparkSession, datasets: Iterable[Dataset], folder: str | None = None
) -> dict[str, dict[str, int]]:
    """Publish datasets in order; one may read those before it by name."""
    return {dataset.name: publish(spark, dataset, folder) for dataset in datasets}


# Name under which a stream's progress has the counts of a micro-batch.
COUNTS = "expectations"


@contextmanager
def _progress_kept(spark: SparkSession) -> Iterator[None]:
    """Let a stream remember the progress of all its micro-batches, not of the last hundred."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _counts_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_counts"


def _keep_counts(spark: SparkSession, query: StreamingQuery, dataset: Dataset) -> dict[str, int]:
    """Store what was counted in each micro-batch of a run, and give the sums."""
    batches = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(COUNTS)
        # Runs of the stream without new rows repeat a batch's number or have none.
        if row is not None and progress.numInputRows:
            batches[progress.batchId] = row.asDict()
    kept = [(query.id, batch, name, count) for batch, counts in batches.items() for name, count in counts.items()]
    if kept:
        schema = "stream string, batch long, name string, count long"
        spark.createDataFrame(kept, schema).coalesce(1).write.mode("append").parquet(_counts_path(dataset.checkpoint))
    names = ["rows", *[expectation.name for expectation in dataset.expectations]]
    return {name: sum(counts[name] for counts in batches.values()) for name in names}


def stream_counts(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """(name, count): rows and failures by expectation in all micro-batches of a streaming table.

    A micro-batch counts once, also if a failure made it run again.
    """
    kept = spark.read.parquet(_counts_path(dataset.checkpoint))
    once = kept.groupBy("stream", "batch", "name").agg(F.max("count").alias("count"))
    return once.groupBy("name").agg(F.sum("count").alias("count"))
