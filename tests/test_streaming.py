import pytest
from pyspark.sql import functions as F

from layerworks.plans.tables import append_stream
from layerworks.sources.files import read_binary, read_binary_stream, to_bronze
from layerworks.streaming.upsert import VersionedTable, upsert_stream


def names(df):
    return sorted(row.file_path.rsplit("/", 1)[1] for row in df.select("file_path").collect())


def test_a_second_run_adds_only_new_files(spark, tmp_path, table_names):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.md").write_text("one")
    (folder / "b.md").write_text("two")
    (folder / "c.skip").write_text("no")
    table, checkpoint = table_names("stream"), str(tmp_path / "checkpoint")

    def run():
        bronze = to_bronze(read_binary(spark, str(folder), "autoloader", "*.md"))
        append_stream(bronze, table, checkpoint)
        return names(spark.table(table))

    assert run() == ["a.md", "b.md"]
    assert run() == ["a.md", "b.md"]
    (folder / "d.md").write_text("three")
    assert run() == ["a.md", "b.md", "d.md"]
    batch = to_bronze(read_binary(spark, str(folder), "batch", "*.md"))
    assert batch.schema.simpleString() == spark.table(table).schema.simpleString()
    contents = lambda df: sorted((r.file_path, bytes(r.binary_content)) for r in df.collect())
    assert contents(batch) == contents(spark.table(table))


def test_a_backlog_is_taken_in_bounded_batches(spark, tmp_path, table_names):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.md").write_text(str(i))
    stream = to_bronze(read_binary_stream(spark, str(folder), max_files_per_trigger=2))
    table = table_names("bounded")
    query = append_stream(stream, table, str(tmp_path / "checkpoint"))
    assert spark.table(table).count() == 5
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3


@pytest.fixture
def target(spark, table_names):
    table = VersionedTable(table_names("target"))
    table.write(spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "k int, v string, t int"), 0)
    return table


def rows(spark, table):
    return sorted(tuple(row) for row in spark.table(table.name).collect())


def write_events(spark, folder, events):
    spark.createDataFrame(events, "k int, v string, t int").coalesce(1).write.mode("append").parquet(folder)


def test_events_take_effect_once_and_in_order(spark, tmp_path, target):
    folder, checkpoint = str(tmp_path / "events"), str(tmp_path / "checkpoint")

    def run():
        stream = spark.readStream.schema("k int, v string, t int").parquet(folder)
        upsert_stream(stream, target, ["k"], ["t"], checkpoint)
        return rows(spark, target)

    write_events(spark, folder, [(2, "b", 2), (2, "a", 1), (3, "new", 1)])
    assert run() == [(1, "old", 0), (2, "b", 2), (3, "new", 1)]
    assert run() == [(1, "old", 0), (2, "b", 2), (3, "new", 1)]
    write_events(spark, folder, [(1, "c", 3)])
    assert run() == [(1, "c", 3), (2, "b", 2), (3, "new", 1)]
    kept = {row.tableName for row in spark.sql(f"SHOW TABLES LIKE '{target.name}_v*'").collect()}
    assert kept == {target.version(1), target.version(2)}


def test_a_batch_run_again_writes_the_same_version(spark, tmp_path, target):
    """A run that failed after writing its version, before its commit, is repeated."""
    folder, checkpoint = str(tmp_path / "events"), str(tmp_path / "checkpoint")
    write_events(spark, folder, [(1, "x", 5)])
    half_written = spark.createDataFrame([(9, "junk", 9)], "k int, v string, t int")
    target.write(half_written, 1)
    stream = spark.readStream.schema("k int, v string, t int").parquet(folder)
    upsert_stream(stream, target, ["k"], ["t"], checkpoint)
    assert rows(spark, target) == [(1, "x", 5), (2, "old", 0)]


def test_versions_in_a_named_schema(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS versions_test")
    table = VersionedTable("versions_test.target", str(tmp_path / "data"))
    table.write(spark.createDataFrame([(1, "old", 0)], "k int, v string, t int"), 0)
    folder = str(tmp_path / "events")
    write_events(spark, folder, [(1, "x", 5)])
    stream = spark.readStream.schema("k int, v string, t int").parquet(folder)
    upsert_stream(stream, table, ["k"], ["t"], str(tmp_path / "checkpoint"))
    assert rows(spark, table) == [(1, "x", 5)]
    spark.sql("DROP SCHEMA versions_test CASCADE")


def test_files_of_dropped_versions_hold_no_rows(spark, tmp_path, table_names):
    table = VersionedTable(table_names("freed"), str(tmp_path / "data"))
    table.write(spark.createDataFrame([(1, "old", 0)], "k int, v string, t int"), 0)
    folder = str(tmp_path / "events")
    for number in range(1, 4):
        write_events(spark, folder, [(number, "x", number)])
        stream = spark.readStream.schema("k int, v string, t int").parquet(folder)
        upsert_stream(stream, table, ["k"], ["t"], str(tmp_path / "checkpoint"))
    held = [spark.read.parquet(str(tmp_path / "data" / table.version(n))).count() for n in range(4)]
    assert held == [0, 0, 2, 3]
    assert rows(spark, table) == [(1, "x", 1), (2, "x", 2), (3, "x", 3)]


def test_ingest_time_is_one_per_batch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.md").write_text("x")
    times = to_bronze(read_binary(spark, str(tmp_path))).select("ingest_timestamp").distinct()
    assert times.count() == 1
    assert times.select(F.col("ingest_timestamp").cast("string").isNotNull()).first()[0]
