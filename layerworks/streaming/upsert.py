"""Change events applied to a table as they arrive."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from layerworks.operators.upsert import upsert
from layerworks.plans.buckets import BucketedTable
from layerworks.plans.tables import VersionedTable


def upsert_stream(
    changes: DataFrame,
    table: VersionedTable,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
) -> StreamingQuery:
    """Apply all change events not applied yet, then stop.

    Micro-batch n reads version n and writes version n + 1.  If it is run again
    after a failure it writes the same version from the same input, so each event
    takes effect once.  The version before the current one is kept for readers.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        current = spark.table(table.version(number))
        table.write(upsert(current, batch, keys, order_by), number + 1)
        table.drop_version(spark, number - 1)

    query = (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; the caller's must see what they wrote.
    table.refresh(changes.sparkSession)
    return query


def upsert_buckets(
    changes: DataFrame, table: BucketedTable, order_by: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Apply all change events not applied yet to a bucketed table, then stop.

    A micro-batch reads and writes the buckets of its keys only.  How far the stream has come is
    kept with the version it made, so a batch that is run again after a failure takes effect once.
    Several streams can change a table one after the other, each with a checkpoint of its own, and
    a stream may go on with a new checkpoint: what comes again is late and changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table.upsert(batch, order_by, stream_id(batch.sparkSession, checkpoint), number)

    query = (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()
    return json.loads(row.value)["id"]
