"""Payload validation as column expressions over a parsed variant.

The constraints are data: field rules by event type. They serve two expressions:

* ``conforms`` is the cheap test nearly all payloads pass. The variant's schema text
  names every key and kind at every level, so one pattern per type checks the shape,
  and only bounds are left to compare.
* ``violations`` explains the rest. It looks each member up in a literal map of rules,
  so the expression stays small however many fields exist.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass
from sys import float_info

from pyspark.sql import Column, functions as F

Bounds = tuple[float, float]
inf = float_info.max


@dataclass(frozen=True)
class FieldRule:
    """What a field may hold: JSON kinds it accepts, each with inclusive bounds.

    ``text`` bounds the length of a string, ``integer`` and ``fraction`` the value of a
    number without and with a decimal point. A kind without bounds is not accepted.
    """

    text: Bounds | None = None
    integer: Bounds | None = None
    fraction: Bounds | None = None
    is_object: bool = False
    required: bool = True


# Constraints of the three payload schemas.
_TYPE = FieldRule(text=(1, 100))
_COUNT = FieldRule(integer=(0, inf))
_NAME = FieldRule(text=(1, 100))
_PLAYER = FieldRule(text=(1, 50))
_USER_ID = FieldRule(text=(1, 50), integer=(0, inf))
PAYLOAD_RULES: dict[str, dict[str, FieldRule]] = {
    "init": {
        "event-type": _TYPE,
        "time": _COUNT,
        "user-id": _USER_ID,
        "country": _NAME,
        "platform": _NAME,
    },
    "match": {
        "event-type": _TYPE,
        "time": _COUNT,
        "user-a": _PLAYER,
        "user-b": _PLAYER,
        "user-a-postmatch-info": FieldRule(is_object=True),
        "user-b-postmatch-info": FieldRule(is_object=True, required=False),
        "winner": _PLAYER,
        "game-tier": FieldRule(integer=(1, 5)),
        "duration": _COUNT,
    },
    "in-app-purchase": {
        "event-type": _TYPE,
        "time": _COUNT,
        "purchase_value": FieldRule(integer=(0, inf), fraction=(0, inf)),
        "user-id": _USER_ID,
        "product-id": _NAME,
    },
}
POSTMATCH_RULES: dict[str, FieldRule] = {
    "coin-balance-after-match": _COUNT,
    "level-after-match": _COUNT,
    "device": FieldRule(text=(1, 200)),
    "platform": FieldRule(text=(1, 10)),
}
POSTMATCH_OBJECTS = ("user-a-postmatch-info", "user-b-postmatch-info")


_RULE_DDL = (
    "struct<text: array<double>, integer: array<double>, fraction: array<double>, "
    "is_object: boolean>"
)


def _literal(value, ddl: str) -> Column:
    """A nested constant; Spark folds the parse into a literal."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def _rules_of(rules: dict[str, FieldRule]) -> dict[str, dict]:
    return {name: asdict(rule) for name, rule in rules.items()}


def _required_of(rules: dict[str, FieldRule]) -> list[str]:
    return [name for name, rule in rules.items() if rule.required]


def _value_ok(member: Column) -> Column:
    """Whether a member with its rule and JSON type satisfies the rule."""
    value, json_type, rule = member["value"], member["json_type"], member["rule"]
    number = F.try_variant_get(value, "$", "double")
    length = F.length(F.try_variant_get(value, "$", "string"))
    # Integers beyond 64 bits parse to a decimal of 19 or more digits.
    is_integer = (json_type == "BIGINT") | json_type.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    is_fraction = json_type.rlike("^(DECIMAL|DOUBLE|FLOAT)")

    def within(measured: Column, bounds: Column) -> Column:
        return measured.between(bounds[0], bounds[1])

    return F.coalesce(
        F.when(json_type == "STRING", within(length, rule["text"]))
        .when(is_integer, within(number, rule["integer"]))
        .when(is_fraction, within(number, rule["fraction"]))
        .when(json_type.startswith("OBJECT"), rule["is_object"]),
        F.lit(False),
    )


def _level_violations(
    members: Column, rules: Column, required: Column, prefix: str = ""
) -> Column:
    """Violations of one object level, given as ``map<string,variant>``."""
    described = F.transform(
        F.map_entries(members),
        lambda entry: F.struct(
            entry["key"].alias("key"),
            entry["value"].alias("value"),
            F.schema_of_variant(entry["value"]).alias("json_type"),
            F.try_element_at(rules, entry["key"]).alias("rule"),
        ),
    )
    verdicts = F.transform(
        described,
        lambda member: F.when(
            member["rule"].isNull(), F.concat(F.lit(prefix), member["key"], F.lit(": unknown"))
        ).when(
            ~_value_ok(member), F.concat(F.lit(prefix), member["key"], F.lit(": invalid"))
        ),
    )
    missing = F.transform(
        F.array_except(required, F.map_keys(members)),
        lambda name: F.concat(F.lit(prefix), name, F.lit(": missing")),
    )
    return F.concat(F.array_compact(verdicts), missing)


_INTEGER = r"(?:BIGINT|DECIMAL\((?:19|[23]\d),0\))"
_FRACTION = r"(?:DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)"


def _kind_pattern(rule: FieldRule, inner: str) -> str:
    kinds = [
        pattern
        for pattern, accepted in (
            ("STRING", rule.text),
            (_INTEGER, rule.integer),
            (_FRACTION, rule.fraction),
            (inner, rule.is_object),
        )
        if accepted
    ]
    return "(?:" + "|".join(kinds) + ")"


def _shape_pattern(rules: dict[str, FieldRule], inner: str = "") -> str:
    """Pattern of the schema text of an object that has the right keys and kinds.

    Keys are sorted in that text. Optional keys must not come last.
    """
    members = []
    for name in sorted(rules):
        key = f"`{name}`" if "-" in name else name
        member = f"{re.escape(key)}: {_kind_pattern(rules[name], inner)}"
        members.append(member if rules[name].required else f"(?:{member}, )?")
    text = ""
    for member in members:
        joint = "" if not text or text.endswith(")?") else ", "
        text += joint + member
    return f"OBJECT<{text}>"


def _bounds(doc: Column, rules: dict[str, FieldRule], parents: tuple[str, ...] = ()) -> Column:
    """Bounds of fields whose shape is known to be right; absent optional ones pass."""
    result = F.lit(True)
    for name, rule in rules.items():
        path = "$" + "".join(f"['{key}']" for key in (*parents, name))
        number = F.try_variant_get(doc, path, "double")
        length = F.length(F.try_variant_get(doc, path, "string"))
        tests = []
        if rule.text:
            tests.append(length.between(*rule.text))
        if rule.integer or rule.fraction:
            tests.append(number.between(*(rule.integer or rule.fraction)))
        if len(tests) == 2:
            # Text that is not a number has no numeric bounds to meet, and vice versa.
            is_text = F.schema_of_variant(F.try_variant_get(doc, path, "variant")) == "STRING"
            result &= F.when(is_text, tests[0]).otherwise(tests[1])
        elif tests:
            result &= F.coalesce(tests[0], F.lit(True))
    return result


def conforms(doc: Column, shape: Column, event_type: Column) -> Column:
    """Whether a payload is valid; ``shape`` is the schema text of ``doc``."""
    inner = _shape_pattern(POSTMATCH_RULES)
    result = F.when(F.lit(False), F.lit(False))
    for kind, rules in PAYLOAD_RULES.items():
        ok = shape.rlike(f"^{_shape_pattern(rules, inner)}$") & _bounds(doc, rules)
        for key in POSTMATCH_OBJECTS:
            if key in rules:
                ok &= _bounds(doc, POSTMATCH_RULES, (key,))
        result = result.when(event_type == kind, ok)
    return F.coalesce(result, F.lit(False))


def payload_members(doc: Column) -> Column:
    """Top-level members of a payload; null unless it is a JSON object."""
    return F.try_variant_get(doc, "$", "map<string,variant>")


def event_type_of(doc: Column) -> Column:
    """The payload's ``event-type`` when it is a JSON string, else null."""
    path = "$['event-type']"
    kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return F.when(kind == "STRING", F.try_variant_get(doc, path, "string"))


def violations(doc: Column, event_type: Column) -> Column:
    """All rule violations of a payload; an empty array means valid.

    ``doc`` is the variant of the payload, null when the text is not JSON.
    """
    members = payload_members(doc)
    rules = {kind: _rules_of(fields) for kind, fields in PAYLOAD_RULES.items()}
    required = {kind: _required_of(fields) for kind, fields in PAYLOAD_RULES.items()}
    found = _level_violations(
        members,
        F.try_element_at(_literal(rules, f"map<string,map<string,{_RULE_DDL}>>"), event_type),
        F.try_element_at(_literal(required, "map<string,array<string>>"), event_type),
    )
    inner = [
        F.coalesce(
            _level_violations(
                F.try_variant_get(
                    F.try_element_at(members, F.lit(key)), "$", "map<string,variant>"
                ),
                _literal(_rules_of(POSTMATCH_RULES), f"map<string,{_RULE_DDL}>"),
                _literal(_required_of(POSTMATCH_RULES), "array<string>"),
                f"{key}.",
            ),
            F.array().cast("array<string>"),
        )
        for key in POSTMATCH_OBJECTS
    ]
    return (
        F.when(members.isNull(), F.array(F.lit("payload: not a JSON object")))
        .when(event_type == "match", F.concat(found, *inner))
        .when(event_type.isin(list(PAYLOAD_RULES)), found)
        .otherwise(F.array(F.lit("event-type: missing or unknown")))
    )
