"""Writing tables, reading them back and dropping them."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def overwrite_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    path: str | None = None,
    replace_schema: bool = True,
) -> DataFrame:
    """Replace a table's rows, and its columns, and read it back.

    Reading the table again, not ``df``, keeps later steps from repeating the work.
    The format is the session's default source.  Without ``replace_schema`` rows of other
    columns are refused before anything is written.  A file table is emptied before it is
    filled, so a failure leaves it without rows: see ``publish_table``.
    """
    if not replace_schema:
        _require_same_columns(df, name)
    writer = df.write.mode("overwrite").option("overwriteSchema", str(replace_schema).lower())
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    return spark.table(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _require_same_columns(df: DataFrame, name: str) -> None:
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return
    columns = [(field.name, field.dataType) for field in spark.table(name).schema]
    given = [(field.name, field.dataType) for field in df.schema]
    if columns != given:
        raise ValueError(f"{name} has other columns than the rows to be written: {columns}, {given}")


class VersionedTable:
    """A table kept as numbered versions behind a view of the current one.

    A plain file table cannot be overwritten while it is read.  Each change writes
    the next version and then points the view at it, so a reader sees one version
    or the other.  ``write(rows, 0)`` starts the table.  With ``folder`` the files
    of the versions are kept there, else in the warehouse.
    """

    def __init__(self, name: str, folder: str | None = None) -> None:
        self.name = name
        self.folder = folder

    def version(self, number: int) -> str:
        return f"{self.name}_v{number}"

    def write(self, df: DataFrame, number: int, comment: str | None = None) -> DataFrame:
        """Write a version, replacing a half-written one, and make it current."""
        table = self.version(number)
        path = f"{self.folder}/{table}" if self.folder else None
        overwrite_table(df, table, comment, path)
        about = f"COMMENT {_quoted(comment)} " if comment else ""
        df.sparkSession.sql(f"CREATE OR REPLACE VIEW {self.name} {about}AS SELECT * FROM {table}")
        return df.sparkSession.table(table)

    def numbers(self, spark: SparkSession) -> list[int]:
        """The versions there are, oldest first; one that was never finished is none."""
        schema, _, table = self.name.rpartition(".")
        where = f"IN {schema} " if schema else ""
        found = spark.sql(f"SHOW TABLES {where}LIKE '{table}_v*'").collect()
        ends = [row.tableName[len(table) + 2 :] for row in found if not row.isTemporary]
        return sorted(int(end) for end in ends if end.isdigit())

    def drop_version(self, spark: SparkSession, number: int) -> None:
        """Drop a version if there is one; its files in ``folder`` are emptied first, as they outlive it."""
        table = self.version(number)
        if number < 0 or not spark.catalog.tableExists(table):
            return
        if self.folder:
            none = spark.createDataFrame([], spark.table(table).schema)
            overwrite_table(none, table, path=f"{self.folder}/{table}")
        drop_table(spark, table)

    def refresh(self, spark: SparkSession) -> None:
        """Make a session forget what it remembers of files since replaced."""
        for number in self.numbers(spark):
            spark.catalog.refreshTable(self.version(number))


def publish_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    folder: str | None = None,
    replace_schema: bool = True,
    keep: int = 2,
) -> DataFrame:
    """Replace a table's rows only once all new ones are written.

    ``name`` is a view of the newest version.  If the rows cannot be computed or written it
    shows the old ones; readers that began before the switch keep their version, as the last
    ``keep`` stay.  Without ``replace_schema`` rows of other columns are refused.  A plain
    table of that name gives way to the view when the rows are there.
    """
    spark, table = df.sparkSession, VersionedTable(name, folder)
    if not replace_schema:
        _require_same_columns(df, name)
    before = table.numbers(spark)
    # The clock makes numbers that a version given up halfway cannot have had.
    number = max([*(n + 1 for n in before[-1:]), time.time_ns() // 1_000_000])
    if not before and spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        path = f"{folder}/{table.version(number)}" if folder else None
        overwrite_table(df, table.version(number), comment, path)
        drop_table(spark, name)
        df = spark.table(table.version(number))
        number += 1
        before = [number - 1]
    rows = table.write(df, number, comment)
    for old in [*before, number][:-keep]:
        table.drop_version(spark, old)
    return rows


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Add rows to a table, creating it if need be."""
    writer = df.write.mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_stream(
    df: DataFrame, name: str, checkpoint: str, path: str | None = None
) -> StreamingQuery:
    """Append what a stream has not delivered yet to a table, then stop.

    The checkpoint remembers what was delivered: a second run adds only what is new.
    """
    writer = (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if path:
        writer = writer.option("path", path)
    query = writer.toTable(name)
    query.awaitTermination()
    return query


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists, or a published one with its versions; files at a path stay."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW":
        table = VersionedTable(name)
        spark.sql(f"DROP VIEW {name}")
        for number in table.numbers(spark):
            spark.sql(f"DROP TABLE {table.version(number)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
