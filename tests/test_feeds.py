from datetime import date
from decimal import Decimal

import fixtures
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from layerworks.config import (
    ConfigError,
    build_schema_from_yaml,
    load_client_config,
    parse_yaml_config,
)
from layerworks.operators import rules
from layerworks.operators.quality import ingest_metrics, split_quarantine
from layerworks.operators.summaries import count_by
from layerworks.plans.datasets import publish_all
from layerworks.plans.feeds import build_common_model, feed_datasets, ingest_to_bronze
from layerworks.plans.tables import drop_table, overwrite_table
from layerworks.queries.feeds import CLIENT_A, CLIENT_B
from layerworks.sources.records import read_bronze, read_source

MODEL = ["employee_id", "base_salary", "department", "join_date", "allowed_roles", "source_client"]


@pytest.fixture
def configs(tmp_path, spark):
    """Both clients' files and configurations on disk, the configurations read back."""
    found = []
    for client, csv, text in [
        ("company_a", fixtures.CLIENT_A_CSV, CLIENT_A),
        ("company_b", fixtures.CLIENT_B_CSV, CLIENT_B),
    ]:
        (tmp_path / client).mkdir()
        (tmp_path / client / "employees.csv").write_text(csv, encoding="utf-8")
        (tmp_path / f"{client}.yaml").write_text(text, encoding="utf-8")
        config = load_client_config(spark, str(tmp_path), client)
        config["source"]["path"] = str(tmp_path / client)
        found.append(config)
    return found


def as_model(df):
    rows = df.select(*MODEL[:3], F.col("join_date").cast("string"), *MODEL[4:])
    return sorted(tuple(row) for row in rows.collect())


def test_layers_step_by_step(spark, configs, table_names):
    tables = [table_names("bronze_a"), table_names("bronze_b")]
    for config, table in zip(configs, tables, strict=True):
        assert tuple(ingest_to_bronze(spark, config, table).first()) == (5, 5, 0)
    silver = build_common_model(spark, zip(configs, tables, strict=True), table_names("cdm"))
    assert silver.columns == list(rules.CDM_COLUMNS)
    assert dict(silver.dtypes) == {
        "employee_id": "string", "base_salary": "int", "department": "string",
        "join_date": "date", "allowed_roles": "string", "source_client": "string",
        "_transformed_at": "timestamp",
    }
    assert as_model(silver) == fixtures.COMMON_MODEL
    counts = count_by(silver, "source_client", "department").collect()
    assert [tuple(row) for row in counts] == fixtures.COUNTS


def test_layers_as_declared_datasets(spark, configs, table_names):
    target = table_names("silver_cdm")
    for config in configs:
        for layer in ("bronze", "quarantine", "silver"):
            # The datasets choose these names themselves.
            drop_table(spark, f"{layer}_{config['client_id']}")
    metrics = publish_all(spark, feed_datasets(configs, target))
    assert as_model(spark.table(target)) == fixtures.COMMON_MODEL
    assert metrics["silver_company_a"] == {"rows": 5, "valid_employee_id": 0, "has_base_salary": 0}
    assert metrics["silver_company_b"] == {
        "rows": 5, "valid_employee_id": 0, "has_base_salary": 1, "has_join_date": 1,
    }
    assert metrics[target] == {"rows": 10}
    assert metrics["quarantine_company_a"] == {"rows": 0}
    described = spark.sql("DESCRIBE TABLE EXTENDED bronze_company_a").collect()
    assert ("Comment", "Company A raw records") in [(r.col_name, r.data_type) for r in described]
    for config in configs:
        for layer in ("bronze", "quarantine", "silver"):
            drop_table(spark, f"{layer}_{config['client_id']}")


def test_malformed_rows_are_kept_with_their_line(spark, configs, tmp_path, table_names):
    lines = [
        "A001,1,HR,2020-01-01",
        "A002,oops,Eng,2019-07-15",
        "A003,1,HR,notadate",
        "A004,5,HR",
        "A005,5,HR,2020-01-01,extra",
        ",7,HR,2020-01-01",
    ]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text("Emp_No,BasePay,Department,JoinDate\n" + "\n".join(lines))
    config = {**configs[0], "source": {**configs[0]["source"], "path": str(tmp_path / "bad")}}
    table = overwrite_table(read_bronze(spark, config), table_names("bad"))
    rows = table.select("Emp_No", "BasePay", "Department", F.col("JoinDate").cast("string"), "_corrupt")
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted(
        [
            ("A001", 1, "HR", "2020-01-01", None),
            ("A002", None, "Eng", "2019-07-15", lines[1]),
            ("A003", 1, "HR", None, lines[2]),
            ("A004", 5, "HR", None, lines[3]),
            ("A005", 5, "HR", "2020-01-01", lines[4]),
            (None, 7, "HR", "2020-01-01", None),
        ],
        key=str,
    )
    good, bad = split_quarantine(table)
    assert (good.count(), bad.count()) == (2, 4)
    assert tuple(ingest_metrics(table).first()) == (6, 2, 4)
    assert {row._source_client for row in table.collect()} == {"company_a"}


def test_schema_gets_the_corrupt_column_without_changing_the_configuration():
    config = parse_yaml_config(CLIENT_A)
    first, second = build_schema_from_yaml(config), build_schema_from_yaml(config)
    assert first == second
    assert first.fieldNames() == ["Emp_No", "BasePay", "Department", "JoinDate", "_corrupt"]
    assert first["_corrupt"].nullable and "comment" in first["_corrupt"].metadata


def test_nested_types_can_be_configured():
    schema = build_schema_from_yaml(
        parse_yaml_config(
            """
            schema:
              type: struct
              fields:
                - name: tags
                  type: {type: array, elementType: string, containsNull: true}
                  nullable: true
            """
        )
    )
    assert schema["tags"].dataType.simpleString() == "array<string>"


def test_bad_configurations_are_named(spark):
    with pytest.raises(ConfigError, match="schema"):
        build_schema_from_yaml({})
    with pytest.raises(ConfigError, match="mapping"):
        parse_yaml_config("- a\n- b")
    with pytest.raises(ConfigError, match="path"):
        read_source(spark, {"file_format": "csv"}, StructType([]))
    with pytest.raises(ConfigError, match="unknown rules: lower"):
        rules.apply_rules(spark.range(1), {"id": [{"lower": True}]})
    with pytest.raises(ConfigError, match="permission_metadata"):
        rules.add_cdm_metadata(spark.range(1), {})
    assert parse_yaml_config("") == {}


def test_rename_ignores_missing_names_and_applies_in_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rules.rename_columns(df, {"x": "y", "a": "c"}).columns == ["c", "b"]
    assert rules.rename_columns(df, {"a": "c", "c": "d"}).columns == ["d", "b"]


def test_rules_turn_bad_values_into_null(spark):
    values = ["¥1,200", "12", "abc", "", None, "99999999999", "1.5"]
    df = spark.createDataFrame([(v,) for v in values], StructType([StructField("v", StringType())]))
    got = rules.apply_rules(df, {"v": [{"strip_chars": "¥,"}, {"cast": "integer"}]})
    assert got.schema["v"].dataType == IntegerType()
    assert [row.v for row in got.collect()] == [1200, 12, None, None, None, None, None]
    dates = ["2020/04/01", "2020-04-01", "2020/13/01", "invalid", None, "2020/4/1", "2021/02/29"]
    df = spark.createDataFrame([(v,) for v in dates], "v string")
    got = rules.apply_rules(df, {"v": {"date_format": "yyyy/MM/dd"}})
    assert [str(row.v) for row in got.collect()] == ["2020-04-01"] + ["None"] * 6


def test_rejected_values_are_told_from_missing_ones(spark):
    rows = [(1, "¥1,200", "x"), (2, "非公開", "2020/04/01"), (3, None, None), (4, "n", "2020-04-01")]
    df = spark.createDataFrame(rows, "k int, v string, d string")
    steps = {"v": [{"strip_chars": "¥,"}, {"cast": "integer"}], "d": {"date_format": "yyyy/MM/dd"}}
    found = rules.rejected_values(df, steps, "k")
    assert sorted(tuple(row) for row in found.collect()) == [
        (1, "d", "date_format", "x"), (2, "v", "cast", "非公開"),
        (4, "d", "date_format", "2020-04-01"), (4, "v", "cast", "n"),
    ]
    counts = rules.rejected_counts(found).collect()
    assert sorted(tuple(row) for row in counts) == [("d", "date_format", 2), ("v", "cast", 2)]
    assert rules.rejected_values(df, None, "k").count() == 0


def test_value_dictionaries(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["a", "b", "z", None, "B"])], "i int, v string")
    got = rules.apply_rules(df, {"v": {"mapping": {"a": "A", "b": "B", "B": "c"}}})
    assert got.columns == ["i", "v"]
    assert [row.v for row in got.orderBy("i").collect()] == ["A", "B", "z", None, "c"]


def test_rules_apply_in_the_order_given(spark):
    df = spark.createDataFrame([("x-1",), ("x-2",)], "v string")
    steps = [{"strip_chars": "-"}, {"mapping": {"x1": "7"}}, {"cast": "integer"}]
    assert [row.v for row in rules.apply_rules(df, {"v": steps}).collect()] == [7, None]


def test_other_record_formats(spark, tmp_path, table_names):
    (tmp_path / "r.json").write_text('{"k": 1, "v": "a"}\n{"k": "x", "v": "b"}\nnot json\n')
    text = """
    client_id: c
    source: {file_format: json, path: "%s"}
    schema:
      type: struct
      fields:
        - {name: k, type: long, nullable: true}
        - {name: v, type: string, nullable: true}
    """
    config = parse_yaml_config(text % (tmp_path / "r.json"))
    table = overwrite_table(read_bronze(spark, config), table_names("json"))
    assert sorted((tuple(r)[:3] for r in table.collect()), key=str) == sorted(
        [(1, "a", None), (None, "b", '{"k": "x", "v": "b"}'), (None, None, "not json")], key=str
    )
    (tmp_path / "t.tsv").write_text("1\ta\n2\tb\n")
    config["source"] = {
        "file_format": "csv", "path": str(tmp_path / "t.tsv"), "options": {"sep": "\t"},
    }
    assert [tuple(r)[:2] for r in read_bronze(spark, config).collect()] == [(1, "a"), (2, "b")]


def test_mapping_keeps_the_type_at_every_size(spark):
    df = spark.createDataFrame([(1, "1"), (700, "x"), (None, None)], "n int, s string")
    for size in (3, 500):
        numbers = rules.apply_rules(df, {"n": {"mapping": {i: i + 1000 for i in range(size)}}})
        assert dict(numbers.dtypes)["n"] == "int"
        assert [r.n for r in numbers.collect()] == [1001, 700, None]
        texts = rules.apply_rules(df, {"s": {"mapping": {i: i + 1000 for i in range(size)}}})
        assert dict(texts.dtypes)["s"] == "string"
        assert [r.s for r in texts.collect()] == ["1001", "x", None]
    with pytest.raises(ConfigError):
        rules.apply_rules(df, {"n": {"mapping": {"one": 2}}})


def test_a_large_dictionary_is_built_and_used_quickly(spark):
    import time

    df = spark.range(0, 200_000, 1, 4).select(F.concat(F.lit("k"), F.col("id")).alias("s"))
    entries = {f"k{i}": f"v{i}" for i in range(100_000)}
    started = time.perf_counter()
    out = rules.apply_rules(df, {"s": {"mapping": entries}})
    assert time.perf_counter() - started < 2
    assert out.where("s like 'v%'").count() == 100_000
    assert time.perf_counter() - started < 30


@pytest.mark.parametrize(
    ("kind", "entries", "values", "expected"),
    [
        ("double", {1.5: 2, "1e20": 7, "nan": 0, "-inf": 1}, [1.5, 1e20, float("nan"), float("-inf"), 3.0], [2.0, 7.0, 0.0, 1.0, 3.0]),
        ("decimal(6,2)", {"1.50": "2.25", 2: 3}, [Decimal("1.50"), Decimal("2.00"), Decimal("9.99")], [Decimal("2.25"), Decimal("3.00"), Decimal("9.99")]),
        ("boolean", {True: False}, [True, False], [False, False]),
        ("date", {date(2024, 1, 2): "2020-02-02"}, [date(2024, 1, 2), date(1, 1, 1)], [date(2020, 2, 2), date(1, 1, 1)]),
        ("long", {-5: 2**62, 2**63 - 1: 0}, [-5, 2**63 - 1, 3], [2**62, 0, 3]),
        ("string", {"": "empty", "日本": "Japan", 'q"\\': "quoted", True: "yes", "keep": None, None: "never"}, ["", "日本", 'q"\\', "true", "keep", None], ["empty", "Japan", "quoted", "yes", "keep", None]),
    ],
)
def test_dictionaries_of_every_type(spark, kind, entries, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = rules.apply_rules(df, {"v": {"mapping": entries}})
    assert dict(out.dtypes)["v"] == dict(df.dtypes)["v"]
    assert [r.v for r in out.orderBy("i").collect()] == expected


def test_keys_that_are_equal_as_the_column_s_type(spark):
    df = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(ConfigError, match="twice"):
        rules.apply_rules(df, {"n": {"mapping": {1: 2, "1": 3}}})
    with pytest.raises(ConfigError):
        rules.apply_rules(df, {"n": {"mapping": {True: 3}}})
