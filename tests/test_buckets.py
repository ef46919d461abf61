from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerworks.plans.buckets import BucketedTable
from layerworks.streaming.upsert import stream_id, upsert_buckets

SCHEMA = "k int, v string, t int"


def make(spark, folder, rows, buckets=8):
    table = BucketedTable(str(folder))
    table.create(spark.createDataFrame(rows, SCHEMA), ["k"], buckets)
    return table


def rows(spark, table, number=None):
    return sorted([tuple(r) for r in table.read(spark, number).collect()], key=str)


def files(folder):
    return {str(p) for p in Path(folder, "data").rglob("*.parquet")}


def test_a_change_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    table = make(spark, tmp_path, [(i, "old", 0) for i in range(2000)], buckets=64)
    before, first = table.version(spark), files(tmp_path)
    changed = [7 * i for i in range(10)]
    after = table.upsert(spark.createDataFrame([(i, "new", 1) for i in changed], SCHEMA), ["t"])
    hashed = spark.createDataFrame([(i,) for i in changed], "k int").select(F.pmod(F.xxhash64("k"), F.lit(64)).cast("int"))
    buckets = {r[0] for r in hashed.collect()}
    assert {Path(f).parent.name for f in files(tmp_path) - first} == {f"_bucket={b}" for b in buckets}
    assert {b for b in after.paths if after.paths[b] != before.paths[b]} == buckets
    assert first < files(tmp_path)
    assert rows(spark, table) == sorted([(i, "new", 1) if i in changed else (i, "old", 0) for i in range(2000)], key=str)
    assert rows(spark, table, 0) == sorted([(i, "old", 0) for i in range(2000)], key=str)


def test_new_old_equal_and_missing_order(spark, tmp_path):
    table = make(spark, tmp_path, [(1, "a", 5), (2, "b", 5), (3, "c", None)])
    changes = [(1, "late", 4), (2, "tie", 5), (3, "first", 1), (4, "x", 1), (4, "y", 2), (None, "n", 1)]
    table.upsert(spark.createDataFrame(changes, SCHEMA), ["t"])
    assert rows(spark, table) == sorted([(1, "a", 5), (2, "tie", 5), (3, "first", 1), (4, "y", 2), (None, "n", 1)], key=str)
    table.upsert(spark.createDataFrame([(None, "m", 0)], SCHEMA), ["t"])
    assert sum(r[0] is None for r in rows(spark, table)) == 2  # a null key matches nothing


def test_no_changes_and_an_empty_table(spark, tmp_path):
    table = make(spark, tmp_path, [])
    assert rows(spark, table) == []
    nothing = spark.createDataFrame([], SCHEMA)
    assert table.upsert(nothing, ["t"]).number == 0
    table.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), ["t"])
    assert rows(spark, table) == [(1, "a", 1)]


def test_a_batch_that_is_run_again_takes_effect_once(spark, tmp_path):
    table = make(spark, tmp_path, [(1, "a", 0)])
    change = spark.createDataFrame([(1, "b", 1)], SCHEMA)
    assert table.upsert(change, ["t"], "s", 0).number == 1
    assert table.upsert(spark.createDataFrame([(1, "junk", 9)], SCHEMA), ["t"], "s", 0).number == 1
    assert table.upsert(spark.createDataFrame([], SCHEMA), ["t"], "s", 1).applied == {"s": 1}
    assert rows(spark, table) == [(1, "b", 1)]


def test_a_failing_change_leaves_the_version_before(spark, tmp_path):
    table = make(spark, tmp_path, [(1, "a", 0)])
    bad = spark.createDataFrame([(1, "b", 1)], SCHEMA).withColumn("v", F.raise_error("broken").cast("string"))
    with pytest.raises(Exception, match="broken"):
        table.upsert(bad, ["t"])
    assert table.version(spark).number == 0 and rows(spark, table) == [(1, "a", 0)]


def test_streams_checkpoints_and_their_progress(spark, tmp_path):
    table = make(spark, tmp_path / "table", [(1, "old", 0), (2, "old", 0)])
    folders = [str(tmp_path / name) for name in ("events_a", "events_b")]

    def write(folder, *events):
        spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run(folder, checkpoint):
        upsert_buckets(spark.readStream.schema(SCHEMA).parquet(folder), table, ["t"], str(tmp_path / checkpoint))
        return rows(spark, table)

    write(folders[0], (1, "a1", 1), (3, "a1", 1))
    assert run(folders[0], "a") == [(1, "a1", 1), (2, "old", 0), (3, "a1", 1)]
    write(folders[1], (1, "b3", 3), (2, "b1", 1))
    assert run(folders[1], "b") == [(1, "b3", 3), (2, "b1", 1), (3, "a1", 1)]
    write(folders[0], (1, "a2", 2), (3, "a2", 2))
    expected = [(1, "b3", 3), (2, "b1", 1), (3, "a2", 2)]
    assert run(folders[0], "a") == expected
    assert run(folders[0], "new checkpoint") == expected
    write(folders[0], (2, "a9", 9))
    assert run(folders[0], "new checkpoint") == [(1, "b3", 3), (2, "a9", 9), (3, "a2", 2)]
    applied = table.version(spark).applied
    ids = [stream_id(spark, str(tmp_path / c)) for c in ("a", "b", "new checkpoint")]
    assert {i: applied[i] for i in ids} == {ids[0]: 1, ids[1]: 0, ids[2]: 1}


def test_unused_folders_hold_no_row_of_the_versions_kept(spark, tmp_path):
    table = make(spark, tmp_path, [(i, "old", 0) for i in range(50)], buckets=4)
    for step in range(1, 4):
        table.upsert(spark.createDataFrame([(i, "new", step) for i in range(50)], SCHEMA), ["t"])
    unused = table.unused(spark, keep=2)
    kept = {p for n in (2, 3) for p in table.version(spark, n).paths.values()}
    assert unused and not kept & set(unused)
    assert rows(spark, table, 2)[0][2] == 2


def test_a_view_for_sql_and_bad_arguments(spark, tmp_path):
    table = make(spark, tmp_path, [(1, "a", 0)])
    table.create_view(spark, "bucketed_view")
    assert spark.sql("SELECT v FROM bucketed_view").first().v == "a"
    with pytest.raises(ValueError):
        table.create(spark.createDataFrame([], SCHEMA), [], 4)
    with pytest.raises(ValueError):
        table.version(spark, 99)
