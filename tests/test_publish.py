import pytest
from pyspark.sql import functions as F

from layerworks.operators.quality import expect, expect_or_drop
from layerworks.plans.datasets import materialized_view, publish, stream_counts, streaming_table
from layerworks.plans.tables import VersionedTable, drop_table, overwrite_table, publish_table


def numbers(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


@pytest.mark.parametrize("with_folder", [True, False])
def test_a_failing_rebuild_leaves_the_old_rows(spark, tmp_path, table_names, with_folder):
    name, folder = table_names("safe"), str(tmp_path) if with_folder else None
    publish_table(spark.range(3), name, "three", folder)
    reader = spark.table(name)
    broken = spark.range(9).select(F.when(F.col("id") > 5, F.raise_error("broken").cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish_table(broken, name, "broken", folder)
    assert numbers(spark, name) == [0, 1, 2]
    publish_table(spark.range(5), name, "five", folder)
    assert numbers(spark, name) == [0, 1, 2, 3, 4]
    assert reader.count() == 3  # the version before stays for those who read it
    publish_table(spark.range(1).select(F.lit("x").alias("other")), name, None, folder)
    assert spark.table(name).columns == ["other"]
    assert len(VersionedTable(name).numbers(spark)) == 2
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and not VersionedTable(name).numbers(spark)


def test_other_columns_are_refused(spark, table_names):
    name = table_names("strict")
    for write in (publish_table, overwrite_table):
        write(spark.range(2), name, replace_schema=False)
        for other in (spark.range(2).withColumn("more", F.lit(1)), spark.range(2).select(F.col("id").cast("int"))):
            with pytest.raises(ValueError, match="other columns"):
                write(other, name, replace_schema=False)
        assert numbers(spark, name) == [0, 1]
        drop_table(spark, name)


def test_a_plain_table_gives_way_to_the_view(spark, table_names):
    name = table_names("plain")
    overwrite_table(spark.range(2), name)
    publish_table(spark.table(name).union(spark.range(5, 6)), name)
    assert numbers(spark, name) == [0, 1, 5]
    assert spark.catalog.getTable(name).tableType == "VIEW"
    publish_table(spark.table(name).union(spark.range(7, 8)), name)  # a table made from itself
    assert numbers(spark, name) == [0, 1, 5, 7]
    drop_table(spark, name)


def test_a_failing_dataset_leaves_the_one_before(spark, tmp_path, table_names):
    name = table_names("dataset")
    publish(spark, materialized_view(name, lambda s: s.range(4), "it's rows"), str(tmp_path))
    bad = materialized_view(name, lambda s: s.range(4).select((F.col("id") / F.lit(0)).alias("id")))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish(spark, bad, str(tmp_path))
    assert numbers(spark, name) == [0, 1, 2, 3]
    drop_table(spark, name)


def test_micro_batches_are_counted_once(spark, tmp_path, table_names):
    source, name = str(tmp_path / "in"), table_names("counted")
    rules = [expect_or_drop("positive", "n > 0"), expect("small", "n < 100")]
    stream = lambda s: s.readStream.schema("n long").option("maxFilesPerTrigger", 1).parquet(source)
    dataset = streaming_table(name, stream, str(tmp_path / "checkpoint"), expectations=rules)

    def arrive(*values):
        spark.createDataFrame([(v,) for v in values], "n long").coalesce(1).write.mode("append").parquet(source)

    arrive(1, 2, -3)
    arrive(None, 500)
    assert publish(spark, dataset) == {"rows": 5, "positive": 2, "small": 2}
    arrive(-1, 7)
    assert publish(spark, dataset) == {"rows": 2, "positive": 1, "small": 0}
    assert publish(spark, dataset) == {"rows": 0, "positive": 0, "small": 0}
    total = lambda: {r.name: r["count"] for r in stream_counts(spark, dataset).collect()}
    assert total() == {"rows": 7, "positive": 3, "small": 2}
    kept = spark.read.parquet(str(tmp_path / "checkpoint_counts"))
    assert kept.select("batch").distinct().count() == 3
    # A batch that ran again after a failure is stored twice and counts once.
    kept.where("batch = 1").coalesce(1).write.mode("append").parquet(str(tmp_path / "checkpoint_counts"))
    assert total() == {"rows": 7, "positive": 3, "small": 2}
    assert numbers(spark, name) == [1, 2, 7, 500]
