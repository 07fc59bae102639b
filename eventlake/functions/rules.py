"""Cleaning rules: named functions that set one target column of a DataFrame.

A rule has the form ``rule(df, field, params) -> df``. Rules that only need an
expression over the source column are written as ``expression(source) -> Column``
and registered with :func:`column_rule`; chained, they collapse into one projection.
"""

from __future__ import annotations

import json
import logging
import zlib
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

log = logging.getLogger(__name__)

Rule = Callable[[DataFrame, str, Mapping[str, Any]], DataFrame]

_RULES: dict[str, Rule] = {}

class MalformedRule(ValueError):
    """A rule that cannot be applied; the chain skips it."""


def register_rule(name: str, rule: Rule) -> Rule:
    """Make a rule available by name; a later registration replaces an earlier one."""
    _RULES[name] = rule
    return rule


def get_rule(name: str) -> Rule:
    if name not in _RULES:
        raise MalformedRule(f"unknown rule {name!r}, available: {list_rules()}")
    return _RULES[name]


def list_rules() -> list[str]:
    return list(_RULES)


def reset_rules() -> None:
    """Forget custom rules and restore the built-in ones."""
    _RULES.clear()
    register_rule("mapping", mapping)
    for name, expression in _BUILT_IN_EXPRESSIONS.items():
        column_rule(name)(expression)


def column_rule(name: str) -> Callable[[Callable[[Column], Column]], Callable[[Column], Column]]:
    """Register ``expression(source) -> Column``; the source defaults to the target."""

    def decorate(expression: Callable[[Column], Column]) -> Callable[[Column], Column]:
        def rule(df: DataFrame, field: str, params: Mapping[str, Any]) -> DataFrame:
            source = params.get("source_field", field)
            return df.withColumn(field, expression(F.col(f"`{source}`")))

        register_rule(name, rule)
        return expression

    return decorate


def mapping(df: DataFrame, field: str, params: Mapping[str, Any]) -> DataFrame:
    """Dictionary lookup of the source column.

    A value without an entry, null included, becomes ``default`` when that is set;
    otherwise it keeps the original when the rule works in place, else it is null.
    """
    entries = params.get("mapping")
    if not entries:
        raise MalformedRule(f"mapping rule for {field!r} has no entries")
    source_name = params.get("source_field", field)
    source = F.col(f"`{source_name}`")
    default = params.get("default")
    if default:
        fallback = F.lit(default)
    elif source_name == field:
        fallback = source
    else:
        fallback = F.lit(None)

    in_place = source_name == field and not default
    text = in_place and isinstance(df.schema[source_name].dataType, T.StringType)
    kind = "string" if text else _value_type([*entries.values(), *([default] if default else [])])
    found = _looked_up(entries, kind, source.cast("string"))
    # An entry may itself map to null, so its presence decides. The literal stands in the plan once.
    return df.withColumn(field, F.coalesce(found, F.struct(fallback.alias("value")))["value"])


def _value_type(values: Iterable[Any]) -> str:
    """Spark type of a dictionary's values, whatever their number.

    Whole numbers are ``int``, or ``bigint`` if one needs it, numbers ``double``, truth values
    ``boolean``; anything else, and mixtures, are ``string``.
    """
    values = [value for value in values if value is not None]
    if values and all(isinstance(value, bool) for value in values):
        return "boolean"
    if not values or any(isinstance(v, bool) or not isinstance(v, (int, float)) for v in values):
        return "string"
    if any(isinstance(value, float) for value in values):
        return "double"
    return "bigint" if any(abs(value) >= 1 << 31 for value in values) else "int"


def _looked_up(entries: Mapping[Any, Any], kind: str, key: Column) -> Column:
    """The entry of a text key as a struct with ``value``, null without one; keys are compared as text.

    The entries are one literal, an array of as many small maps as there are entries. CRC-32, which Python
    and Spark compute alike, says which map a key is in, so a lookup looks at one entry or two
    whatever their number. A null key has no entry.
    """
    parts: list[dict[str, Any]] = [{} for _ in entries]
    for entry, value in entries.items():
        text = _text(entry)
        shown = _text(value) if kind == "string" else value
        parts[zlib.crc32(text.encode()) % len(parts)][text] = {"value": shown}
    table = F.from_json(F.lit(json.dumps(parts)), f"array<map<string,struct<value:{kind}>>>")
    part = F.get(table, (F.crc32(key.cast("binary")) % len(parts)).cast("int"))
    return F.try_element_at(part, key)


def _text(value: Any) -> str | None:
    """As Spark casts it to text; null stays null."""
    return None if value is None else str(value).lower() if isinstance(value, bool) else str(value)


_BUILT_IN_EXPRESSIONS = {"uppercase": F.upper, "lowercase": F.lower, "trim": F.trim}
reset_rules()


def map_values(source: Column, entries: Mapping[str, str]) -> Column:
    """Lookup in a literal dictionary; a value without an entry becomes null."""
    return _looked_up(entries, _value_type(entries.values()), source.cast("string"))["value"]


def apply_rules(df: DataFrame, rules: Iterable[Mapping[str, Any]] | None) -> DataFrame:
    """Apply rules in order; later ones see the output of earlier ones.

    A malformed rule is logged and skipped. A missing source column is an error of
    the data, not of the rule, and stops the job.
    """
    for rule in rules or ():
        try:
            params = rule.get("params", {})
            if params is None:
                raise MalformedRule(f"rule has null params: {rule}")
            df = get_rule(rule["type"])(df, rule["field"], params)
        except (ValueError, KeyError, AttributeError) as error:
            log.error("skipping rule %s: %s", rule, error)
    return df
