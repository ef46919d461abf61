"""Access attributes and reads through them; change events applied to a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.operators.access import attach_access, create_secure_view, visible_rows
from layerworks.operators.newest import newest_per_key
from layerworks.operators.policies import create_policy_view
from layerworks.operators.upsert import upsert
from layerworks.plans.buckets import BucketedTable
from layerworks.queries.documents import CONFIG
from layerworks.queries.inputs import detach, fresh_name, table
from layerworks.session import scratch_path
from layerworks.streaming.upsert import VersionedTable, upsert_stream
from layerworks.streaming.upsert import upsert_buckets as upsert_stream_buckets


def chunk_access(spark: SparkSession, folder: str) -> DataFrame:
    return attach_access(table(spark, folder, "documents").select("doc_id", "text"), CONFIG)


def _guarded(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with roles by their source and a department by their language."""
    roles = (
        F.when(F.col("source").isin("src0", "src1", "src2"), "analyst,manager")
        .when(F.col("source").isin("src3", "src4", "src5"), "senior_analyst")
        .when(F.col("source").isin("src6", "src7"), "")
        .otherwise("manager")
    )
    return table(spark, folder, "documents").select(
        "doc_id", "text", roles.alias("allowed_roles"), F.col("lang").alias("department")
    )


def access_filter(spark: SparkSession, folder: str) -> DataFrame:
    return visible_rows(_guarded(spark, folder), ["analyst", "guest"], "en")


def secure_view(spark: SparkSession, folder: str) -> DataFrame:
    name = fresh_name("secured_documents")
    create_secure_view(_guarded(spark, folder), name, ["manager"], "en", masked=["text"])
    return spark.table(name)


def _rights(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Members and policies made from the given tables: segments are roles, numbers are users."""
    customer = table(spark, folder, "customer")
    role = F.lower("c_mktsegment")
    members = customer.select(F.concat(F.lit("user"), F.col("c_custkey") % 40).alias("user"), role.alias("role"))
    roles = customer.select(role.alias("role")).distinct()
    langs = table(spark, folder, "documents").select("lang").distinct()
    size = F.length("role")
    rows = roles.join(langs, (size + F.ascii("lang")) % 2 == 0)
    masks = roles.select("role", F.lit("text").alias("column"), F.element_at(F.array(*map(F.lit, ("show", "hash", "hide"))), size % 3 + 1).alias("rule"), F.lit(None).cast("string").alias("value"))
    lengths = roles.where(size > 8).select("role", F.lit("n_chars").alias("column"), F.lit("show").alias("rule"), F.lit(None).cast("string").alias("value"))
    policies = rows.select("role", F.lit("lang").alias("column"), F.lit("rows").alias("rule"), F.col("lang").alias("value"))
    return members, policies.unionByName(masks).unionByName(lengths)


def policy_view(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as three users see them by roles, row rules and masks read from tables."""
    names = {label: fresh_name(label) for label in ("documents", "members", "policies")}
    members, policies = _rights(spark, folder)
    for label, df in (("documents", table(spark, folder, "documents")), ("members", members), ("policies", policies)):
        df.createOrReplaceTempView(names[label])
    seen = []
    for user in ("user3", "user5", "nobody"):
        view = fresh_name("seen")
        create_policy_view(spark, view, names["documents"], names["policies"], names["members"], user, temporary=True)
        seen.append(spark.table(view).withColumn("reader", F.lit(user)))
    return reduce(DataFrame.unionByName, seen)


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    """The table before any change: customers without an order."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.lit("none").alias("status"),
        F.lit(-1).cast("long").alias("orderkey"),
        F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")).alias("changed_at"),
    )


def _order_events(orders: DataFrame) -> DataFrame:
    """Orders as change events of their customers."""
    return orders.select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderdate").alias("changed_at"),
    )


NEWEST = ["changed_at", "orderkey"]


def _shown(rows: DataFrame) -> DataFrame:
    day: Column = F.col("changed_at").cast("date")
    return rows.select("custkey", "status", "orderkey", day.alias("changed_on"))


def newest_event(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return newest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_events(table(spark, folder, "orders"))
    return _shown(upsert(_customers(spark, folder), changes, ["custkey"], NEWEST))


def upsert_streaming(spark: SparkSession, folder: str) -> DataFrame:
    """The same changes, arriving as a stream; a second run finds nothing new."""
    name = fresh_name("customers")
    target = VersionedTable(name, scratch_path(spark, name))
    target.write(_customers(spark, folder), 0)
    orders = table(spark, folder, "orders")
    arriving = spark.readStream.schema(orders.schema).parquet(f"{folder.rstrip('/')}/orders.parque[t]")
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        upsert_stream(_order_events(arriving), target, ["custkey"], NEWEST, checkpoint)
    spark.sql(f"DROP VIEW {name}")
    return _shown(detach(spark, target.version(1)))


def _bucketed_customers(spark: SparkSession, folder: str) -> BucketedTable:
    target = BucketedTable(scratch_path(spark, "customers"))
    target.create(_customers(spark, folder), ["custkey"], 16)
    return target


def upsert_two_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams change one bucketed table; then the first begins again with a new checkpoint."""
    target = _bucketed_customers(spark, folder)
    orders = table(spark, folder, "orders")
    arriving = spark.readStream.schema(orders.schema).parquet(f"{folder.rstrip('/')}/orders.parque[t]")
    even = F.col("o_orderkey") % 2 == 0
    for part in (even, ~even, even):
        events = _order_events(arriving.where(part))
        upsert_stream_buckets(events, target, NEWEST, scratch_path(spark, "checkpoint"))
    return _shown(target.read(spark))


def upsert_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Three arrivals of events, the newest first: what comes late changes only keys without newer ones."""
    target = _bucketed_customers(spark, folder)
    events = _order_events(table(spark, folder, "orders"))
    path, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "checkpoint")
    year = F.year("changed_at")
    for part in (year >= 1997, (year >= 1995) & (year < 1997), year < 1995):
        events.where(part).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(events.schema).parquet(path)
        upsert_stream_buckets(arriving, target, NEWEST, checkpoint)
    return _shown(target.read(spark))


def upsert_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """A few keys change, so few buckets of the table are written anew."""
    target = _bucketed_customers(spark, folder)
    events = _order_events(table(spark, folder, "orders"))
    target.upsert(events.where(F.col("custkey") <= 10), NEWEST)
    return _shown(target.read(spark))


QUERIES = {
    "upsert_buckets": upsert_buckets,
    "upsert_two_streams": upsert_two_streams,
    "upsert_late_events": upsert_late_events,
    "chunk_access": chunk_access,
    "access_filter": access_filter,
    "secure_view": secure_view,
    "policy_view": policy_view,
    "newest_event": newest_event,
    "upsert_latest": upsert_latest,
    "upsert_streaming": upsert_streaming,
}

_GUARDED = """
    WITH guarded AS (
        SELECT doc_id, text, lang AS department,
               CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'analyst,manager'
                    WHEN source IN ('src3', 'src4', 'src5') THEN 'senior_analyst'
                    WHEN source IN ('src6', 'src7') THEN '' ELSE 'manager' END AS allowed_roles
        FROM documents
    )
"""

_UPSERT = """
    WITH newest AS (
        SELECT o_custkey, o_orderstatus, o_orderkey, o_orderdate FROM orders
        QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    )
    SELECT c_custkey AS custkey, coalesce(o_orderstatus, 'none') AS status,
           coalesce(o_orderkey, -1) AS orderkey,
           CAST(coalesce(o_orderdate, TIMESTAMP '1970-01-01') AS DATE) AS changed_on
    FROM customer FULL JOIN newest ON c_custkey = o_custkey
"""

ORACLES = {
    "chunk_access": """
        SELECT doc_id, text, 'analyst,manager' AS allowed_roles, 'engineering' AS department FROM documents
    """,
    "access_filter": f"""{_GUARDED}
        SELECT * FROM guarded
        WHERE department = 'en' AND list_contains(string_split(allowed_roles, ','), 'analyst')
    """,
    "secure_view": f"""{_GUARDED}
        SELECT doc_id, CASE WHEN department = 'en' THEN text END AS text, allowed_roles, department
        FROM guarded WHERE list_contains(string_split(allowed_roles, ','), 'manager')
    """,
    "policy_view": """
        WITH members AS (
            SELECT DISTINCT 'user' || (c_custkey % 40) AS reader, lower(c_mktsegment) AS role FROM customer
        ), readers AS (SELECT * FROM (VALUES ('user3'), ('user5'), ('nobody')) AS r(reader)),
        held AS (SELECT reader, role FROM members JOIN readers USING (reader)),
        rights AS (
            SELECT reader, lang,
                   bool_or((length(role) + ascii(lang)) % 2 = 0) AS sees,
                   bool_or(length(role) % 3 = 0) AS shows, bool_or(length(role) % 3 = 1) AS hashes,
                   bool_or(length(role) > 8) AS counts
            FROM held CROSS JOIN (SELECT DISTINCT lang FROM documents) GROUP BY reader, lang
        )
        SELECT doc_id, CASE WHEN shows THEN text WHEN hashes THEN sha256(text) END AS text, lang, source,
               CASE WHEN counts THEN n_chars END AS n_chars, reader
        FROM documents JOIN rights USING (lang) WHERE sees
    """,
    "newest_event": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
    "upsert_latest": _UPSERT,
    "upsert_streaming": _UPSERT,
    "upsert_two_streams": _UPSERT,
    "upsert_late_events": _UPSERT,
    "upsert_buckets": _UPSERT.replace("FROM orders\n", "FROM orders WHERE o_custkey <= 10\n"),
}
