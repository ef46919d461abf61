"""Applying change events to a table: the newest event of a key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.operators.newest import newest_per_key


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The target with every key's newest row: of the changes, or the one it has if that is newer.

    Late events therefore change nothing, and the result does not depend on how events fall into
    batches.  An incoming row wins a tie.  The changes are reduced to a row per key before they
    meet the target.  Order columns that the target lacks are not compared; as in a merge, a null
    key matches nothing.
    """
    newest = newest_per_key(changes, keys, order_by).select(*target.columns)
    return merge_newest(target, newest, keys, order_by)


def merge_newest(
    target: DataFrame, newest: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """``upsert`` of changes that have a row per key already.  Both sides are read once."""
    known = [name for name in order_by if name in target.columns]

    def side(df: DataFrame, name: str) -> DataFrame:
        named = [F.col(f"`{key}`").alias(f"_key_{i}") for i, key in enumerate(keys)]
        return df.select(*named, F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias(name))

    names = [f"_key_{i}" for i in range(len(keys))]
    held, fresh = F.col("held"), F.col("fresh")
    row = F.when(fresh.isNull(), held).when(held.isNull(), fresh)
    if known:
        order = [F.struct(*[row_side[name] for name in known]) for row_side in (held, fresh)]
        row = row.when(order[0] > order[1], held)
    joined = side(target, "held").join(side(newest, "fresh"), names, "full")
    return joined.select(row.otherwise(fresh).alias("row")).select("row.*")
