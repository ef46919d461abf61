import pytest

from layerworks.config import ConfigError, check_client_config, check_parsing_config, department_scope, strategy_table
from layerworks.operators.quality import not_null_expectations
from layerworks.plans.feeds import feed_expectations
from layerworks.config import build_schema_from_yaml, parse_yaml_config
from layerworks.queries.feeds import CLIENT_A, CLIENT_B, RECORDS_CONFIG

SOURCE = {"source": {"path": "/x"}}


@pytest.mark.parametrize(
    "chunking",
    [
        {"md": "markdown_header"}, {"pdf": {"strategy": "semantic"}}, {"pdf": {"max_chars": 0}}, {"pdf": {"max_chars": "many"}},
        {"pdf": {"max_chars": True}}, {"pdf": {"overlap": -1}}, {"pdf": {"max_chars": 100, "overlap": 100}}, {"default": {"max_chars": 1.5}},
    ],
)
def test_strategies_that_cannot_be_followed(chunking):
    with pytest.raises(ConfigError, match="chunking of"):
        check_parsing_config({**SOURCE, "chunking": chunking})


def test_strategies_are_resolved_once():
    table = strategy_table({"chunking": {"pdf": {"max_chars": 800}, "odd": None, "default": {"overlap": 5}}})
    assert table == {"pdf": {"max_chars": 800}, None: {"overlap": 5}}
    assert strategy_table({}) == {None: {"strategy": "paragraph", "max_chars": 1000, "overlap": 100}}


def test_modes_scopes_and_sections():
    assert check_parsing_config(SOURCE) == SOURCE
    for bad in ({"source": {"path": "/x", "mode": "hourly"}}, {}, {**SOURCE, "permission_metadata": {"allowed_roles": "all"}}):
        with pytest.raises(ConfigError):
            check_parsing_config(bad)
    assert department_scope({}) == department_scope({"department_scope": "from_data"}) == "from_data"
    client = parse_yaml_config(CLIENT_A)
    assert check_client_config(client) == client
    for change in ({"permission_metadata": {"allowed_roles": ["a"], "department_scope": "elsewhere"}}, {"schema": None}):
        with pytest.raises((ConfigError, TypeError)):
            check_client_config({**client, **change})
    with pytest.raises(ConfigError, match="client_id"):
        check_client_config({k: v for k, v in client.items() if k != "client_id"})


def test_expectations_follow_the_schema():
    schema = build_schema_from_yaml(parse_yaml_config(RECORDS_CONFIG))
    assert [e.name for e in not_null_expectations(schema)] == ["valid_number"]
    for text in (CLIENT_A, CLIENT_B):
        config = parse_yaml_config(text)
        names = [e.name for e in feed_expectations(config)]
        assert names[0] == "valid_employee_id" and "has_base_salary" in names
        fields = [{**f, "nullable": False} if f["name"] in ("Department", "部門") else f for f in config["schema"]["fields"]]
        stricter = {**config, "schema": {**config["schema"], "fields": fields}}
        found = {e.name: e for e in feed_expectations(stricter)}
        assert found["valid_department"].drop
