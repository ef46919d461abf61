"""A keyed table whose changes rewrite only the buckets they touch.

Rows are dealt to buckets by a hash of the key, a folder of files each.  A version of the table is a
list of such folders, one for each bucket that has rows.  A change writes new folders for the buckets
of its keys, then the list; until the list is there, readers see the version before, whose files
stay.  With the list the table keeps how far each stream of changes has been applied, so that neither
a repeated micro-batch nor a new checkpoint is taken for something else.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerworks.operators.newest import newest_per_key
from layerworks.operators.upsert import merge_newest

BUCKET = "_bucket"
VERSIONS = "version long, schema string, keys array<string>, buckets int, paths map<int,string>, applied map<string,long>"


@dataclass(frozen=True)
class Version:
    """What a version consists of: folders by bucket, and the last batch of each stream."""

    number: int
    schema: StructType
    keys: list[str]
    buckets: int
    paths: Mapping[int, str] = field(default_factory=dict)
    applied: Mapping[str, int] = field(default_factory=dict)


class BucketedTable:
    """The table in a folder that all executors reach."""

    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")

    def create(self, df: DataFrame, keys: Sequence[str], buckets: int) -> Version:
        """Start the table with rows as they are, one for each key.

        Choose ``buckets`` so that one is some hundred megabytes: a change rewrites whole buckets.
        """
        if buckets < 1 or not keys:
            raise ValueError("a bucketed table needs keys and at least one bucket")
        start = Version(-1, df.schema, list(keys), buckets)
        return self._commit(df.withColumn(BUCKET, self._bucket(start)), start, range(buckets), {})

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """The current version, or an earlier one."""
        listed = spark.read.schema(VERSIONS).parquet(f"{self.folder}/versions")
        if number is None:
            # The numbers are names of folders, so only one version's list is read.
            number = listed.agg(F.max("version")).first()[0]
        row = listed.where(F.col("version") == number).first() if number is not None else None
        if row is None:
            raise ValueError(f"no version {number} in {self.folder}")
        schema = StructType.fromJson(json.loads(row["schema"]))
        return Version(row["version"], schema, row["keys"], row["buckets"], row["paths"], row["applied"])

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The rows of the current version, or of an earlier one."""
        version = self.version(spark, number)
        return self._rows(spark, version, version.paths)

    def create_view(self, spark: SparkSession, name: str) -> None:
        """Register the current version for SQL; later changes do not show in it."""
        self.read(spark).createOrReplaceTempView(name)

    def unused(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Folders of earlier versions that none of the last ``keep`` versions has: free to be removed."""
        versions = [r[0] for r in spark.read.schema(VERSIONS).parquet(f"{self.folder}/versions").select("version").distinct().collect()]
        last = sorted(versions)[-keep:]
        used = {path for number in last for path in self.version(spark, number).paths.values()}
        before = {path for number in versions if number not in last for path in self.version(spark, number).paths.values()}
        return sorted(before - used)

    def upsert(
        self, changes: DataFrame, order_by: Sequence[str], stream: str | None = None, batch: int = 0
    ) -> Version:
        """Give every changed key its newest row, of the changes or the table, and keep the progress.

        Only buckets with a changed key are read and written.  A ``batch`` of a ``stream`` that is
        not after the last one applied changes nothing.  No changes make a version all the same if
        there is progress to keep.  A null key matches nothing: each such row is added.
        """
        spark = changes.sparkSession
        before = self.version(spark)
        if stream is not None and before.applied.get(stream, -1) >= batch:
            return before
        newest = newest_per_key(changes, before.keys, order_by).select(*before.schema.fieldNames())
        fresh = newest.withColumn(BUCKET, self._bucket(before)).persist()
        try:
            touched = sorted(row[0] for row in fresh.select(BUCKET).distinct().collect())
            held = self._rows(spark, before, [b for b in touched if b in before.paths])
            merged = merge_newest(held, fresh.drop(BUCKET), before.keys, order_by)
            progress = {stream: batch} if stream is not None else {}
            if not touched and not progress:
                return before
            return self._commit(merged.withColumn(BUCKET, self._bucket(before)), before, touched, progress)
        finally:
            fresh.unpersist()

    def _bucket(self, version: Version) -> Column:
        keys = [F.col(f"`{key}`") for key in version.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(version.buckets)).cast("int")

    def _rows(self, spark: SparkSession, version: Version, buckets: Sequence[int] | Mapping[int, str]) -> DataFrame:
        paths = [version.paths[bucket] for bucket in buckets]
        if not paths:
            return spark.createDataFrame([], version.schema)
        return spark.read.schema(version.schema).parquet(*paths)

    def _commit(self, rows: DataFrame, before: Version, touched: Sequence[int], progress: Mapping[str, int]) -> Version:
        """Write the touched buckets to a new folder, then the list that makes them current."""
        spark = rows.sparkSession
        number = before.number + 1
        data = f"{self.folder}/data/{number}-{uuid.uuid4().hex}"
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(data)
        filled = spark.read.schema(f"{BUCKET} int").parquet(data).select(BUCKET).distinct().collect()
        paths = {b: p for b, p in before.paths.items() if b not in set(touched)}
        paths |= {row[0]: f"{data}/{BUCKET}={row[0]}" for row in filled}
        after = Version(number, before.schema, before.keys, before.buckets, paths, {**before.applied, **progress})
        listed = (before.schema.json(), after.keys, after.buckets, dict(after.paths), dict(after.applied))
        columns = VERSIONS.removeprefix("version long, ")
        # One row is one file, which appears when it is complete.
        spark.createDataFrame([listed], columns).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/versions/version={number}")
        return after
