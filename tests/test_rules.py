from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventlake.functions import rules
from eventlake.functions.preprocess import get_preprocess
from eventlake.plans.event_types import (
    CONFIG_FILE,
    default_event_types,
    load_event_types,
    load_rules,
)

NAMES = {"US": "United States", "UK": "United Kingdom"}


@pytest.fixture(autouse=True)
def built_in_rules():
    rules.reset_rules()
    yield
    rules.reset_rules()


def apply(spark, values, *steps, column="country"):
    df = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return rules.apply_rules(df, steps)


def column_of(df, name):
    return [row[name] for row in df.collect()]


def mapping(field, **params):
    return {"field": field, "type": "mapping", "params": params}


def test_uppercase(spark):
    df = apply(
        spark, ["android", "ios", None], {"field": "p", "type": "uppercase"}, column="p"
    )
    assert column_of(df, "p") == ["ANDROID", "IOS", None]


@pytest.mark.parametrize("size", [2, 50, 51])
@pytest.mark.parametrize(
    "field,default,expected",
    [
        ("name", "Unknown", ["United States", "Unknown", "Unknown"]),
        ("name", None, ["United States", None, None]),
        ("name", "", ["United States", None, None]),
        ("country", None, ["United States", "ZZ", None]),
        ("country", "Unknown", ["United States", "Unknown", "Unknown"]),
    ],
)
def test_mapping(spark, size, field, default, expected):
    """The number of entries changes nothing."""
    entries = NAMES | {f"X{i}": f"Country {i}" for i in range(size - 2)}
    step = mapping(field, source_field="country", mapping=entries, default=default)
    df = apply(spark, ["US", "ZZ", None], step)
    assert sorted(map(str, column_of(df, field))) == sorted(map(str, expected))


@pytest.mark.parametrize("size", [2, 50, 51, 100_001])
def test_mapping_has_one_type_at_every_size(spark, size):
    entries = {"US": 7} | {f"X{i}": i for i in range(size - 1)}
    df = apply(spark, ["US", "ZZ", "X0"], mapping("n", source_field="country", mapping=entries))
    assert dict(df.dtypes)["n"] == "int"
    assert column_of(df, "n") == [7, None, 0]


@pytest.mark.parametrize(
    "values,kind",
    [
        ([1, 2.5], "double"),
        ([1 << 40], "bigint"),
        ([True, False], "boolean"),
        ([1, "a"], "string"),
        ([True, 1], "string"),
        ([None], "string"),
    ],
)
def test_mapping_types(spark, values, kind):
    step = mapping("n", source_field="country", mapping=dict(enumerate(values)))
    assert dict(apply(spark, ["0"], step).dtypes)["n"] == kind


def test_mapping_in_place_keeps_text(spark):
    df = apply(spark, ["US", "ZZ"], mapping("country", mapping={"US": 1}))
    assert column_of(df, "country") == ["1", "ZZ"]


@pytest.mark.parametrize("size", [50, 51])
def test_mapping_to_null_is_not_a_missing_entry(spark, size):
    entries = {"US": None} | {f"X{i}": "x" for i in range(size - 1)}
    df = apply(spark, ["US", "ZZ"], mapping("n", source_field="country", mapping=entries, default="D"))
    assert sorted(map(str, column_of(df, "n"))) == ["D", "None"]


@pytest.mark.parametrize(
    "bad",
    [
        mapping("name", source_field="country", mapping={}),
        {"field": "name", "type": "no_such_rule"},
        {"type": "uppercase"},
        {"field": "country"},
        {"field": "country", "type": "uppercase", "params": None},
        {"field": "name", "type": "mapping"},
    ],
)
def test_malformed_rule_is_skipped(spark, bad):
    df = apply(spark, ["us"], bad, {"field": "country", "type": "uppercase"})
    assert df.columns == ["country"]
    assert column_of(df, "country") == ["US"]


def test_missing_source_column_fails(spark):
    with pytest.raises(AnalysisException):
        apply(
            spark,
            ["us"],
            {"field": "x", "type": "uppercase", "params": {"source_field": "none"}},
        ).collect()


def test_later_rules_see_earlier_output(spark):
    df = apply(
        spark,
        [" us "],
        {"field": "country", "type": "trim"},
        {"field": "country", "type": "uppercase"},
        mapping("country", mapping=NAMES),
    )
    assert column_of(df, "country") == ["United States"]


def test_no_rules_leave_input_unchanged(spark):
    assert apply(spark, ["US"]).collect() == rules.apply_rules(apply(spark, ["US"]), None).collect()


def test_registry():
    assert rules.list_rules() == ["mapping", "uppercase", "lowercase", "trim"]
    rules.column_rule("same")(lambda c: c)
    rules.register_rule("trim", lambda df, field, params: df)
    assert "same" in rules.list_rules()
    with pytest.raises(ValueError, match="available"):
        rules.get_rule("none")
    rules.reset_rules()
    assert "same" not in rules.list_rules()


def test_map_literal(spark):
    df = apply(spark, ["US", "ZZ", None]).select(rules.map_values(F.col("country"), NAMES).alias("n"))
    assert column_of(df, "n") == ["United States", None, None]


def test_default_event_types():
    kinds = default_event_types()
    assert {k: v.event_filter for k, v in kinds.items()} == {
        "init": "init",
        "match": "match",
        "purchase": "in-app-purchase",
    }
    assert kinds["match"].preprocess is get_preprocess("flatten_match_fields")
    assert kinds["init"].preprocess is None


def test_registry_errors(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_event_types(tmp_path / "none.yml")
    for text in ("other: 1", "", "events:\n  - event_type: init", "events: ["):
        path = tmp_path / "bad.yml"
        path.write_text(text)
        with pytest.raises(ValueError):
            load_event_types(path)


def test_new_type_needs_only_configuration(tmp_path):
    (tmp_path / "login_rules.yml").write_text(
        "transformations:\n  - {field: platform, type: uppercase}\n"
    )
    registry = tmp_path / "types.yml"
    registry.write_text(
        "events:\n  - {event_type: login, event_filter: login, silver_table: login,\n"
        "     transform_key: login, preprocessing: none, rules_file: login_rules.yml}\n"
    )
    [login] = load_event_types(registry)
    assert login.preprocess is None
    assert login.rules == [{"field": "platform", "type": "uppercase"}]


def test_unreadable_rules_are_empty(tmp_path):
    broken = tmp_path / "broken.yml"
    broken.write_text("transformations: [")
    assert load_rules(broken) == []
    assert load_rules(tmp_path / "none.yml") == []
    assert CONFIG_FILE.exists()
