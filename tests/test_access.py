import hashlib

import pytest

from pyspark.sql import functions as F

from layerworks.operators.access import attach_access, create_secure_view, visible_rows
from layerworks.operators.policies import create_policy_view

ROWS = [
    (1, "analyst,manager", "eng", "a"),
    (2, "senior_analyst", "eng", "b"),
    (3, "manager", "hr", "c"),
    (4, "", "eng", "d"),
    (5, None, "eng", "e"),
]


@pytest.fixture
def chunks(spark):
    return spark.createDataFrame(ROWS, "id int, allowed_roles string, department string, text string")


def ids(df):
    return sorted(row.id for row in df.collect())


def test_roles_are_compared_whole(chunks):
    assert ids(visible_rows(chunks, ["analyst"])) == [1]
    assert ids(visible_rows(chunks, ["manager", "guest"])) == [1, 3]
    assert ids(visible_rows(chunks, ["manager"], "hr")) == [3]
    assert ids(visible_rows(chunks, ["nobody"])) == []
    assert ids(visible_rows(chunks, [])) == []


def test_the_secure_view_hides_rows_and_masks_columns(spark, chunks):
    create_secure_view(chunks, "secure_chunks", ["manager"], "hr", ["text"])
    got = spark.sql("SELECT id, text FROM secure_chunks ORDER BY id").collect()
    assert [tuple(row) for row in got] == [(1, None), (3, "c")]


def test_missing_access_configuration_is_empty(chunks):
    row = attach_access(chunks.select("id"), {}).first()
    assert (row.allowed_roles, row.department) == ("", "")


@pytest.fixture
def guarded(spark):
    """A table, members and policies as temporary views, and a function that reads as a user."""
    spark.createDataFrame([(1, "en", "a", 10), (2, "de", "b", 20), (3, None, "c", 30)], "k int, lang string, text string, pay int").createOrReplaceTempView("pv_rows")

    def read(user, policies, members, **options):
        spark.createDataFrame(policies, "role string, column string, rule string, value string").createOrReplaceTempView("pv_policies")
        spark.createDataFrame(members, "user string, role string").createOrReplaceTempView("pv_members")
        create_policy_view(spark, "pv_seen", "pv_rows", "pv_policies", "pv_members", user, temporary=True, **options)
        return sorted(tuple(r) for r in spark.table("pv_seen").collect())

    return read


def test_policies_are_read_from_tables(guarded):
    policies = [
        ("reader", "lang", "rows", "en"), ("german", "lang", "rows", "de"), ("boss", "lang", "rows", "*"),
        ("reader", "text", "hash", None), ("boss", "text", "show", None), ("reader", "pay", "hide", None), ("boss", "pay", "show", None),
    ]
    members = [("ann", "reader"), ("bob", "reader"), ("bob", "german"), ("bob", "german"), ("cleo", "boss"), ("o'x", "reader")]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert guarded("ann", policies, members) == [(1, "en", digest("a"), None)]
    assert guarded("bob", policies, members) == [(1, "en", digest("a"), None), (2, "de", digest("b"), None)]
    assert guarded("cleo", policies, members) == [(1, "en", "a", 10), (2, "de", "b", 20), (3, None, "c", 30)]
    assert guarded("o'x", policies, members) == [(1, "en", digest("a"), None)]
    assert guarded("nobody", policies, members) == []
    assert guarded("nobody", [], members) == [(1, "en", "a", 10), (2, "de", "b", 20), (3, None, "c", 30)]
    best = [("reader", "pay", "hide", None), ("german", "pay", "hash", None), ("german", "pay", "show", None)]
    assert [r[3] for r in guarded("bob", best, members)] == [10, 20, 30]
    assert [r[3] for r in guarded("ann", [("reader", "pay", "hash", None)], members)] == [None] * 3
    assert [r[0] for r in guarded("ann", [("reader", "lang", "rows", None)], members)] == [3]


def test_policies_with_roles_in_the_rows(guarded, spark):
    spark.sql("SELECT k, if(k = 1, 'reader,x', 'boss') AS lang, text, pay FROM pv_rows").createOrReplaceTempView("pv_rows")
    assert [r[0] for r in guarded("ann", [], [("ann", "reader")], roles_column="lang")] == [1]
    assert guarded("nobody", [], [("ann", "reader")], roles_column="lang") == []


def test_bad_policies_are_refused(guarded):
    for bad in (("reader", "text", "showw", None), (None, "text", "show", None), ("reader", None, "show", None)):
        with pytest.raises(ValueError, match="not policies"):
            guarded("ann", [bad], [])


def test_a_view_follows_its_policy_tables(spark, table_names):
    source, policies, members, view = (table_names(n) for n in ("pol_rows", "pol_rules", "pol_members", "pol_view"))
    spark.range(3).withColumn("t", F.lit("x")).write.saveAsTable(source)
    spark.createDataFrame([("reader", "t", "hide", None)], "role string, column string, rule string, value string").write.saveAsTable(policies)
    spark.createDataFrame([(spark.sql("SELECT current_user()").first()[0], "reader")], "user string, role string").write.saveAsTable(members)
    create_policy_view(spark, view, source, policies, members)
    assert {r.t for r in spark.table(view).collect()} == {None}
    spark.createDataFrame([("reader", "t", "show", None)], "role string, column string, rule string, value string").write.insertInto(policies)
    assert {r.t for r in spark.table(view).collect()} == {"x"}
