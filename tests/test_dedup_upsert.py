import pytest
from pyspark.sql import functions as F

from layerworks.operators.dedup import dedup_documents
from layerworks.operators.newest import newest_per_key
from layerworks.operators.upsert import upsert


def test_the_smallest_id_survives_and_null_is_one_text(spark):
    rows = [("c", "x", 1), ("a", "x", 2), ("b", "y", 3), ("e", None, 4), ("d", None, 5), ("f", "", 6)]
    df = spark.createDataFrame(rows, "document_id string, extracted_text string, n int").repartition(3)
    got = sorted(tuple(row) for row in dedup_documents(df).collect())
    assert got == [("a", "x", 2), ("b", "y", 3), ("d", None, 5), ("f", "", 6)]
    assert dedup_documents(df).columns == df.columns


def test_null_and_repeated_ids(spark):
    rows = [(None, "x", 1), ("a", "x", 2), ("b", "y", 3), ("b", "y", 3)]
    df = spark.createDataFrame(rows, "document_id string, extracted_text string, n int")
    assert sorted(row.n for row in dedup_documents(df).collect()) == [1, 3]


def test_maps_and_odd_names_pass_through(spark):
    df = spark.createDataFrame([("a", "x", {"k": "v"})], "`the.id` string, `a b` string, m map<string,string>")
    (row,) = dedup_documents(df, "a b", ["the.id"]).collect()
    assert tuple(row) == ("a", "x", {"k": "v"})


def test_a_hot_text_and_a_hot_key(spark):
    """Most rows share one text; one row of it per task reaches the shuffle."""
    df = spark.range(0, 50_000, numPartitions=8).select(
        F.format_string("%08d", "id").alias("document_id"),
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("extracted_text"),
    )
    kept = dedup_documents(df)
    assert kept.count() == 10_001
    assert kept.where("extracted_text = 'hot'").first().document_id == "00000000"
    newest = newest_per_key(df, ["extracted_text"], ["document_id"])
    assert newest.where("extracted_text = 'hot'").first().document_id == "00049997"


TARGET = [(1, "old", 1), (2, "old", 1), (3, "old", 1), (None, "kept", 1)]
CHANGES = [(2, "late", 5), (2, "early", 3), (4, "new", 2), (3, "older", 0)]


@pytest.fixture
def tables(spark):
    schema = "k int, v string, t int"
    return spark.createDataFrame(TARGET, schema), spark.createDataFrame(CHANGES, schema)


def test_upsert(tables):
    target, changes = tables
    got = upsert(target, changes, ["k"], ["t", "v"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "old", 1), (2, "late", 5), (3, "old", 1), (None, "kept", 1), (4, "new", 2)], key=str
    )
    again = upsert(got, changes, ["k"], ["t", "v"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)


def test_upsert_takes_the_targets_columns(tables):
    target, changes = tables
    extra = changes.withColumn("event", F.lit(1)).select("event", "t", "v", "k")
    assert upsert(target, extra, ["k"], ["t", "v"]).columns == ["k", "v", "t"]


def test_late_events_change_nothing(spark):
    base = spark.createDataFrame([(1, "base", 0), (2, "kept", 5)], "k int, v string, t int")
    events = [(1, "new", 9), (1, "late", 3), (2, "old", 4), (2, "tie", 5), (3, "c", 1), (3, "b", 0)]
    whole = upsert(base, spark.createDataFrame(events, base.schema), ["k"], ["t"])
    expected = sorted(map(tuple, whole.collect()))
    assert expected == [(1, "new", 9), (2, "tie", 5), (3, "c", 1)]
    for order in (events, events[::-1], events[2:] + events[:2]):
        table = base
        for event in order:
            table = upsert(table, spark.createDataFrame([event], base.schema), ["k"], ["t"])
        assert sorted(map(tuple, table.collect())) == expected
