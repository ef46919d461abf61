"""Configured feeds: malformed records, column rules, the common model, expectations."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.config import build_schema_from_yaml, load_client_config, parse_yaml_config
from layerworks.operators import rules
from layerworks.operators.quality import (
    apply_expectations,
    expect,
    expectation_metrics,
    malformed,
    not_null_expectations,
    well_formed,
)
from layerworks.operators.quality import expect_or_drop as expect_or_drop_rule
from layerworks.operators.quality import ingest_metrics as count_records
from layerworks.operators.rules import apply_rules, to_common_model, union_clients
from layerworks.operators.summaries import count_by
from layerworks.plans.datasets import publish, publish_all, stream_counts, streaming_table
from layerworks.plans.feeds import HAS_JOIN_DATE, HAS_SALARY, VALID_ID, feed_datasets
from layerworks.plans.tables import overwrite_table
from layerworks.queries.inputs import detach, fresh_name, table
from layerworks.session import scratch_path
from layerworks.sources.literals import literal_rows
from layerworks.sources.records import add_ingest_metadata, read_bronze, read_source

MODEL = ["employee_id", "base_salary", "department", "join_date", "allowed_roles", "source_client"]

RECORDS_CONFIG = """
client_id: customers
source:
  file_format: csv
  options: {header: "false", encoding: "UTF-8"}
schema:
  type: struct
  fields:
    - {name: number, type: long, nullable: false}
    - {name: name, type: string, nullable: true}
    - {name: balance, type: double, nullable: true}
    - {name: segment, type: string, nullable: true}
"""

# The two clients' schemas, column names, rules and roles.
CLIENT_A = """
client_id: company_a
client_name: Company A
source:
  file_format: csv
  options: {header: "true", encoding: "UTF-8"}
schema:
  type: struct
  fields:
    - {name: Emp_No, type: string, nullable: false}
    - {name: BasePay, type: integer, nullable: true}
    - {name: Department, type: string, nullable: true}
    - {name: JoinDate, type: date, nullable: true}
column_mapping:
  Emp_No: employee_id
  BasePay: base_salary
  Department: department
  JoinDate: join_date
  Nickname: alias
permission_metadata:
  allowed_roles: [analyst, manager]
  department_scope: from_data
"""

CLIENT_B = """
client_id: company_b
client_name: Company B
source:
  file_format: csv
  options: {header: "true", encoding: "UTF-8"}
schema:
  type: struct
  fields:
    - {name: 社員番号, type: string, nullable: false}
    - {name: 基本給, type: string, nullable: true}
    - {name: 部門, type: string, nullable: true}
    - {name: 入社日, type: string, nullable: true}
column_mapping:
  社員番号: employee_id
  基本給: base_salary
  部門: department
  入社日: join_date
transformations:
  base_salary:
    - strip_chars: "¥,"
    - cast: integer
  join_date:
    - date_format: "yyyy/MM/dd"
  department:
    mapping:
      営業部: Sales
      開発部: Engineering
      人事部: HR
permission_metadata:
  allowed_roles: [analyst]
  department_scope: from_data
"""


def _every(key: str, number: int) -> Column:
    return F.col(key) % number == 0


def _record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as CSV lines: some with text for a number, a field missing or one too many."""
    key, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    balance = F.format_string("%.2f", "c_acctbal")
    line = (
        F.when(_every("c_custkey", 7), F.concat_ws(",", key, name, F.lit("unknown"), segment))
        .when(_every("c_custkey", 11), F.concat_ws(",", key, name, balance))
        .when(_every("c_custkey", 13), F.concat_ws(",", key, name, balance, segment, F.lit("more")))
        .when(_every("c_custkey", 17), F.concat_ws(",", F.lit(""), name, balance, segment))
        .otherwise(F.concat_ws(",", key, name, balance, segment))
    )
    return table(spark, folder, "customer").select(line.alias("value"))


def _bronze_records(spark: SparkSession, folder: str) -> DataFrame:
    """The lines written as files, read under the configured schema, and written as Bronze."""
    config = parse_yaml_config(RECORDS_CONFIG)
    path = scratch_path(spark, "customer_lines")
    _record_lines(spark, folder).write.text(path)
    records = read_source(spark, {**config["source"], "path": path}, build_schema_from_yaml(config))
    name = fresh_name("bronze_customers")
    overwrite_table(
        add_ingest_metadata(records, config["client_id"]), name, path=scratch_path(spark, name)
    )
    return detach(spark, name)


def ingest_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze_records(spark, folder)
    return bronze.drop("_ingested_at")


def ingest_clean(spark: SparkSession, folder: str) -> DataFrame:
    return well_formed(_bronze_records(spark, folder)).select("number", "name", "balance", "segment")


def ingest_malformed(spark: SparkSession, folder: str) -> DataFrame:
    return malformed(_bronze_records(spark, folder)).select("_corrupt")


def ingest_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return count_records(_bronze_records(spark, folder))


def _yen(key: str, amount: str) -> Column:
    return F.when(_every(key, 9), F.lit("非公開")).otherwise(
        F.concat(F.lit("¥"), F.format_number(F.floor(amount), 0))
    )


def _slashed(key: str, date: str) -> Column:
    return F.when(_every(key, 8), F.lit("invalid_date")).otherwise(
        F.date_format(date, "yyyy/MM/dd")
    )


def rule_strip_cast(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", _yen("o_orderkey", "o_totalprice").alias("amount")
    )
    return apply_rules(orders, {"amount": [{"strip_chars": "¥,"}, {"cast": "integer"}]})


def rule_date(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", _slashed("o_orderkey", "o_orderdate").alias("ordered_on")
    )
    return apply_rules(orders, {"ordered_on": [{"date_format": "yyyy/MM/dd"}]})


def rejected_values(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts and dates that do not convert, a few of them missing from the start."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(~_every("o_orderkey", 5), _yen("o_orderkey", "o_totalprice")).alias("amount"),
        _slashed("o_orderkey", "o_orderdate").alias("ordered_on"),
    )
    transformations = {
        "amount": [{"strip_chars": "¥,"}, {"cast": "integer"}],
        "ordered_on": {"date_format": "yyyy/MM/dd"},
    }
    return rules.rejected_values(orders, transformations, "o_orderkey")


def rejected_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rejected_counts(rejected_values(spark, folder))


def rule_mapping(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    names = {"AUTOMOBILE": "自動車", "BUILDING": "建築", "MACHINERY": "機械"}
    return apply_rules(customer, {"c_mktsegment": {"mapping": names}})


def rule_mapping_long(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    names = {f"Customer#{number:09d}": f"client {number}" for number in range(0, 1000, 2)}
    return apply_rules(customer, {"c_name": {"mapping": names}})


def rule_mapping_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Dictionaries of a whole-number, a decimal and a date column; results keep the types."""
    parts = table(spark, folder, "part").select("p_partkey", "p_size", F.col("p_retailprice").cast("decimal(12,2)").alias("price"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size").cast("int")).alias("day"))
    return apply_rules(
        parts,
        {
            "p_size": {"mapping": {size: 100 * size for size in range(1, 51, 3)}},
            "price": {"mapping": {f"{cents // 100}.{cents % 100:02d}": cents for cents in range(90_000, 110_000)}},
            "day": {"mapping": {"2024-01-11": "1999-12-31", "2024-02-01": "2030-01-01"}},
        },
    )


def _client_a(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in the shape of client A; some have no number."""
    return table(spark, folder, "customer").select(
        F.when(~_every("c_custkey", 97), F.concat(F.lit("A"), "c_custkey")).alias("Emp_No"),
        F.floor("c_acctbal").cast("int").alias("BasePay"),
        F.col("c_mktsegment").alias("Department"),
        F.date_add(F.lit("2018-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias(
            "JoinDate"
        ),
    )


def _client_b(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the shape of client B, with amounts and dates that do not parse."""
    names = ["営業部", "開発部", "人事部", "総務部"]
    department = F.element_at(
        F.array(*map(F.lit, names)), (F.col("o_custkey") % len(names) + 1).cast("int")
    )
    return table(spark, folder, "orders").select(
        F.concat(F.lit("B"), "o_orderkey").alias("社員番号"),
        _yen("o_orderkey", "o_totalprice").alias("基本給"),
        department.alias("部門"),
        _slashed("o_orderkey", "o_orderdate").alias("入社日"),
    )


def _model(spark: SparkSession, folder: str) -> DataFrame:
    clients = [
        to_common_model(_client_a(spark, folder), parse_yaml_config(CLIENT_A)),
        to_common_model(_client_b(spark, folder), parse_yaml_config(CLIENT_B)),
    ]
    return union_clients(clients).select(MODEL)


def cdm_union(spark: SparkSession, folder: str) -> DataFrame:
    return _model(spark, folder)


def _with_files(spark: SparkSession, rows: DataFrame, config: dict[str, Any]) -> dict[str, Any]:
    """Write a client's rows as its files; gives the configuration that points at them."""
    path = scratch_path(spark, f"{config['client_id']}_files")
    rows.write.csv(path, header=True)
    return {**config, "source": {**config["source"], "path": path}}


def _from_files(spark: SparkSession, rows: DataFrame, config: dict[str, Any]) -> DataFrame:
    """A client's rows written as its files, ingested to Bronze, and its common model."""
    located = _with_files(spark, rows, config)
    name = fresh_name(f"bronze_{config['client_id']}")
    overwrite_table(read_bronze(spark, located), name, path=scratch_path(spark, name))
    return to_common_model(well_formed(detach(spark, name)), config)


def published_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Both clients from their files to the common model, as declared datasets."""
    configs = [
        _with_files(spark, _client_a(spark, folder), parse_yaml_config(CLIENT_A)),
        _with_files(spark, _client_b(spark, folder), parse_yaml_config(CLIENT_B)),
    ]
    datasets = feed_datasets(configs, prefix=fresh_name("feeds") + "_")
    publish_all(spark, datasets, scratch_path(spark, "published_feeds"))
    tables = [detach(spark, dataset.name) for dataset in datasets]
    return tables[-1].select(MODEL)


def cdm_from_files(spark: SparkSession, folder: str) -> DataFrame:
    clients = [
        _from_files(spark, _client_a(spark, folder), parse_yaml_config(CLIENT_A)),
        _from_files(spark, _client_b(spark, folder), parse_yaml_config(CLIENT_B)),
    ]
    return union_clients(clients).select(MODEL)


def cdm_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(_model(spark, folder), "source_client", "department")


EXPECTATIONS = [VALID_ID, HAS_SALARY, HAS_JOIN_DATE]


def expect_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return expectation_metrics(_model(spark, folder), EXPECTATIONS)


def expect_or_drop(spark: SparkSession, folder: str) -> DataFrame:
    return apply_expectations(_model(spark, folder), EXPECTATIONS)


def expect_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The columns a schema declares not nullable, checked on records as read."""
    required = not_null_expectations(build_schema_from_yaml(parse_yaml_config(RECORDS_CONFIG)))
    return expectation_metrics(_bronze_records(spark, folder), required)


def config_location(spark: SparkSession, folder: str) -> DataFrame:
    """Both clients by configurations kept as files, found by the client's id."""
    place = scratch_path(spark, "configs")
    for client, text in (("company_a", CLIENT_A), ("company_b", CLIENT_B)):
        literal_rows(spark, [(text,)], ["value"]).write.text(f"{place}/{client}.yaml")
    clients = [
        to_common_model(rows(spark, folder), load_client_config(spark, place, client))
        for client, rows in (("company_a", _client_a), ("company_b", _client_b))
    ]
    return union_clients(clients).select(MODEL)


def expect_stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and failures of a streaming table that arrived in three micro-batches."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    source = scratch_path(spark, "events")
    for number in range(3):
        arriving = events.where(F.col("event_id") % 3 == number)
        arriving.coalesce(1).write.mode("append").parquet(source)
    stream = streaming_table(
        fresh_name("counted_events"),
        lambda s: s.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source),
        scratch_path(spark, "checkpoint"),
        expectations=[expect_or_drop_rule("no_error", "event_type <> 'error'"), expect("small", "value < 50")],
    )
    publish(spark, stream, scratch_path(spark, "counted"))
    kept = detach(spark, stream.name).agg(F.lit("written").alias("name"), F.count("*").alias("count"))
    return stream_counts(spark, stream).unionByName(kept)


QUERIES = {
    "expect_schema": expect_schema,
    "config_location": config_location,
    "expect_stream_metrics": expect_stream_metrics,
    "ingest_quarantine": ingest_quarantine,
    "ingest_clean": ingest_clean,
    "ingest_malformed": ingest_malformed,
    "ingest_metrics": ingest_metrics,
    "rule_strip_cast": rule_strip_cast,
    "rule_date": rule_date,
    "rule_mapping": rule_mapping,
    "rule_mapping_long": rule_mapping_long,
    "rule_mapping_typed": rule_mapping_typed,
    "cdm_union": cdm_union,
    "cdm_from_files": cdm_from_files,
    "published_feeds": published_feeds,
    "rejected_values": rejected_values,
    "rejected_counts": rejected_counts,
    "cdm_counts": cdm_counts,
    "expect_metrics": expect_metrics,
    "expect_or_drop": expect_or_drop,
}

_RECORDS = """
    WITH fields AS (
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment, printf('%.2f', c_acctbal) AS balance,
               CASE WHEN c_custkey % 7 = 0 THEN 'text' WHEN c_custkey % 11 = 0 THEN 'short'
                    WHEN c_custkey % 13 = 0 THEN 'long' WHEN c_custkey % 17 = 0 THEN 'unnumbered'
                    ELSE 'good' END AS kind
        FROM customer
    ), bronze AS (
        SELECT CASE WHEN kind <> 'unnumbered' THEN c_custkey END AS number, c_name AS name,
               CASE WHEN kind <> 'text' THEN c_acctbal END AS balance,
               CASE WHEN kind <> 'short' THEN c_mktsegment END AS segment,
               CASE kind WHEN 'text' THEN concat_ws(',', c_custkey, c_name, 'unknown', c_mktsegment)
                         WHEN 'short' THEN concat_ws(',', c_custkey, c_name, balance)
                         WHEN 'long' THEN concat_ws(',', c_custkey, c_name, balance, c_mktsegment, 'more')
               END AS _corrupt,
               'customers' AS _source_client
        FROM fields
    )
"""

_YEN = """CASE WHEN o_orderkey % 9 <> 0 THEN CAST(floor(o_totalprice) AS INTEGER) END"""
_DAY = """CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderdate AS DATE) END"""

_MODEL = f"""
    WITH model AS (
        SELECT CASE WHEN c_custkey % 97 <> 0 THEN 'A' || c_custkey END AS employee_id,
               CAST(floor(c_acctbal) AS INTEGER) AS base_salary, c_mktsegment AS department,
               DATE '2018-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS join_date,
               'analyst,manager' AS allowed_roles, 'company_a' AS source_client
        FROM customer
        UNION ALL
        SELECT 'B' || o_orderkey, {_YEN},
               CASE o_custkey % 4 WHEN 0 THEN 'Sales' WHEN 1 THEN 'Engineering' WHEN 2 THEN 'HR'
                    ELSE '総務部' END,
               {_DAY}, 'analyst', 'company_b'
        FROM orders
    )
"""

ORACLES = {
    "expect_schema": f"""{_RECORDS}
        SELECT 'valid_number' AS expectation, 'drop' AS action, count(number) AS passed,
               count(*) - count(number) AS failed FROM bronze
    """,
    "config_location": f"{_MODEL} SELECT * FROM model",
    "expect_stream_metrics": """
        SELECT 'rows' AS name, count(*) AS count FROM events
        UNION ALL SELECT 'no_error', count(*) FILTER (event_type = 'error') FROM events
        UNION ALL SELECT 'small', count(*) FILTER (NOT coalesce(value < 50, false)) FROM events
        UNION ALL SELECT 'written', count(*) FILTER (event_type <> 'error') FROM events
    """,
    "ingest_quarantine": f"{_RECORDS} SELECT * FROM bronze",
    "ingest_clean": f"{_RECORDS} SELECT number, name, balance, segment FROM bronze WHERE _corrupt IS NULL",
    "ingest_malformed": f"{_RECORDS} SELECT _corrupt FROM bronze WHERE _corrupt IS NOT NULL",
    "ingest_metrics": f"""{_RECORDS}
        SELECT count(*) AS total, count(*) FILTER (_corrupt IS NULL) AS good,
               count(_corrupt) AS corrupt FROM bronze
    """,
    "rule_strip_cast": f"SELECT o_orderkey, {_YEN} AS amount FROM orders",
    "rule_date": f"SELECT o_orderkey, {_DAY} AS ordered_on FROM orders",
    "rule_mapping": """
        SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '自動車' WHEN 'BUILDING' THEN '建築'
               WHEN 'MACHINERY' THEN '機械' ELSE c_mktsegment END AS c_mktsegment
        FROM customer
    """,
    "rule_mapping_long": """
        SELECT c_custkey, CASE WHEN c_custkey < 1000 AND c_custkey % 2 = 0
               THEN 'client ' || c_custkey ELSE c_name END AS c_name
        FROM customer
    """,
    "rule_mapping_typed": """
        WITH parts AS (
            SELECT p_partkey, p_size, CAST(p_retailprice AS DECIMAL(12, 2)) AS price,
                   CAST(DATE '2024-01-01' + CAST(p_size AS INTEGER) AS DATE) AS day
            FROM part
        )
        SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 50 AND p_size % 3 = 1 THEN p_size * 100 ELSE p_size END AS p_size,
               CASE WHEN price >= 900 AND price < 1100 THEN CAST(price * 100 AS DECIMAL(12, 2)) ELSE price END AS price,
               CASE day WHEN DATE '2024-01-11' THEN DATE '1999-12-31' WHEN DATE '2024-02-01' THEN DATE '2030-01-01'
                    ELSE day END AS day
        FROM parts
    """,
    "cdm_union": f"{_MODEL} SELECT * FROM model",
    "cdm_from_files": f"{_MODEL} SELECT * FROM model",
    "published_feeds": f"{_MODEL} SELECT * FROM model WHERE employee_id IS NOT NULL",
    "rejected_values": """
        SELECT o_orderkey, 'amount' AS "column", 'cast' AS rule, '非公開' AS raw
        FROM orders WHERE o_orderkey % 9 = 0 AND o_orderkey % 5 <> 0
        UNION ALL
        SELECT o_orderkey, 'ordered_on', 'date_format', 'invalid_date' FROM orders WHERE o_orderkey % 8 = 0
    """,
    "rejected_counts": """
        SELECT 'amount' AS "column", 'cast' AS rule, count(*) AS n_rejected
        FROM orders WHERE o_orderkey % 9 = 0 AND o_orderkey % 5 <> 0
        UNION ALL
        SELECT 'ordered_on', 'date_format', count(*) FROM orders WHERE o_orderkey % 8 = 0
    """,
    "cdm_counts": f"""{_MODEL}
        SELECT source_client, department, count(*) AS count FROM model GROUP BY ALL
    """,
    "expect_metrics": f"""{_MODEL}
        SELECT 'valid_employee_id' AS expectation, 'drop' AS action, count(employee_id) AS passed,
               count(*) - count(employee_id) AS failed FROM model
        UNION ALL
        SELECT 'has_base_salary', 'warn', count(base_salary), count(*) - count(base_salary) FROM model
        UNION ALL
        SELECT 'has_join_date', 'warn', count(join_date), count(*) - count(join_date) FROM model
    """,
    "expect_or_drop": f"{_MODEL} SELECT * FROM model WHERE employee_id IS NOT NULL",
}
