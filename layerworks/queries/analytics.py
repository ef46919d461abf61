"""Filters, derived columns, summaries, joins, and a table written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.operators.summaries import (
    at_least,
    band,
    first_by,
    in_thousands,
    summarize,
    summarize_sql,
    with_dimension,
)
from layerworks.plans.tables import append_table, overwrite_table
from layerworks.queries.inputs import detach, fresh_name, table
from layerworks.session import scratch_path
from layerworks.sources.literals import literal_rows


def filter_project(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return at_least(orders, ["o_orderkey", "o_custkey", "o_totalprice"], "o_totalprice", 200000.0)


def derive_columns(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    bands = [(0.0, "debt"), (3000.0, "low"), (7000.0, "middle")]
    return customer.select("c_custkey", "c_name", "c_acctbal").withColumns(
        {
            "balance_k": in_thousands(F.col("c_acctbal")),
            "balance_band": band(F.col("c_acctbal"), bands, "high"),
            "name_upper": F.upper("c_name"),
        }
    )


def dept_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarize(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice")


def dept_summary_sql(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return summarize_sql(orders, "o_orderpriority", "o_totalprice", "orders_by_priority")


def join_dimension(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    joined = with_dimension(table(spark, folder, "customer"), nation, "c_nationkey")
    return joined.select("c_custkey", "c_name", "c_nationkey", "n_name", "n_regionkey").orderBy(
        "c_nationkey", "c_custkey"
    )


def join_literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    departments = literal_rows(
        spark,
        [("AUTOMOBILE", "Tokyo"), ("BUILDING", "Osaka"), ("MACHINERY", "Tokyo")],
        ["c_mktsegment", "location"],
    )
    joined = with_dimension(table(spark, folder, "customer"), departments, "c_mktsegment")
    return joined.select("c_custkey", "c_mktsegment", "location")


def write_read_back(spark: SparkSession, folder: str) -> DataFrame:
    name = fresh_name("summary")
    overwrite_table(dept_summary(spark, folder), name, path=scratch_path(spark, name))
    return detach(spark, name)


def overwrite_new_schema(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    name = fresh_name("replaced")
    path = scratch_path(spark, name)
    overwrite_table(customer.select("c_custkey", "c_name"), name, path=path)
    overwrite_table(customer.select("c_custkey", "c_mktsegment", "c_acctbal"), name, path=path)
    return detach(spark, name)


def append_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    name = fresh_name("change_events")
    path = scratch_path(spark, name)
    is_error = F.col("event_type") == "error"
    append_table(events.where(~is_error), name, path)
    append_table(events.where(is_error), name, path)
    return detach(spark, name)


def hidden_sort(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty richest customers, without their balance."""
    richest = [F.desc("c_acctbal"), F.col("c_custkey")]
    return first_by(table(spark, folder, "customer"), ["c_custkey", "c_name"], richest, 20)


QUERIES = {
    "hidden_sort": hidden_sort,
    "filter_project": filter_project,
    "derive_columns": derive_columns,
    "dept_summary": dept_summary,
    "dept_summary_sql": dept_summary_sql,
    "join_dimension": join_dimension,
    "join_literal_rows": join_literal_rows,
    "write_read_back": write_read_back,
    "overwrite_new_schema": overwrite_new_schema,
    "append_events": append_events,
}

_SUMMARY = """
    SELECT o_orderpriority, count(*) AS headcount, round(avg(o_totalprice), 0) AS avg_amount,
           max(o_totalprice) AS max_amount
    FROM orders GROUP BY o_orderpriority
"""

ORACLES = {
    "hidden_sort": "SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
    "filter_project": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 200000
    """,
    "derive_columns": """
        SELECT c_custkey, c_name, c_acctbal, round(c_acctbal / 1000, 0) + 0.0 AS balance_k,
               CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 3000 THEN 'low'
                    WHEN c_acctbal < 7000 THEN 'middle' ELSE 'high' END AS balance_band,
               upper(c_name) AS name_upper
        FROM customer
    """,
    "dept_summary": _SUMMARY,
    "dept_summary_sql": _SUMMARY,
    "join_dimension": """
        SELECT c_custkey, c_name, c_nationkey, n_name, n_regionkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
    "join_literal_rows": """
        SELECT c_custkey, c_mktsegment,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Osaka' ELSE 'Tokyo' END AS location
        FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
    """,
    "write_read_back": _SUMMARY,
    "overwrite_new_schema": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    "append_events": "SELECT event_id, user_id, event_type, value FROM events",
}
