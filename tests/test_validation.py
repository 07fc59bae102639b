from __future__ import annotations

import json

import pytest

from eventlake.operators.bronze import drop_unparseable
from eventlake.operators.validity import (
    observe_validity,
    route_topics,
    valid_events,
    validate_events,
    validation_summary,
)
from pyspark.sql import Observation

INIT = {"event-type": "init", "time": 1, "user-id": "u", "country": "US", "platform": "iOS"}
POST = {"coin-balance-after-match": 1, "level-after-match": 2, "device": "d", "platform": "iOS"}
MATCH = {
    "event-type": "match",
    "time": 1,
    "user-a": "a",
    "user-b": "b",
    "user-a-postmatch-info": POST,
    "user-b-postmatch-info": POST,
    "winner": "a",
    "game-tier": 3,
    "duration": 0,
}
PURCHASE = {
    "event-type": "in-app-purchase",
    "time": 1,
    "purchase_value": 4.99,
    "user-id": "u",
    "product-id": "PROD001",
}


def without(event, *keys):
    return {key: value for key, value in event.items() if key not in keys}


VALID = [
    INIT,
    INIT | {"user-id": 7},
    INIT | {"user-id": 0},
    INIT | {"user-id": "x" * 50},
    INIT | {"time": 0},
    INIT | {"country": "é" * 100},
    INIT | {"time": 2**63 + 5},
    MATCH,
    without(MATCH, "user-b-postmatch-info"),
    MATCH | {"game-tier": 1},
    MATCH | {"game-tier": 5},
    MATCH | {"winner": "someone else"},
    MATCH | {"user-b": "a"},
    PURCHASE,
    PURCHASE | {"purchase_value": 0},
    PURCHASE | {"purchase_value": 1e20},
    PURCHASE | {"user-id": 12},
]
INVALID = {
    "event-type: missing or unknown": [
        without(INIT, "event-type"),
        INIT | {"event-type": "login"},
        INIT | {"event-type": ""},
        INIT | {"event-type": 5},
        INIT | {"event-type": None},
    ],
    "time: missing": [without(INIT, "time"), without(MATCH, "time"), without(PURCHASE, "time")],
    "time: invalid": [
        INIT | {"time": value} for value in (-1, 1.5, 1.0, "12", True, None, [1], {"a": 1})
    ],
    "user-id: invalid": [
        INIT | {"user-id": value} for value in (-1, "", "x" * 51, 1.5, True, None)
    ],
    "country: invalid": [INIT | {"country": value} for value in ("", "x" * 101, 1, None)],
    "country: missing": [without(INIT, "country")],
    "extra: unknown": [event | {"extra": 1} for event in (INIT, MATCH, PURCHASE)],
    "game-tier: invalid": [MATCH | {"game-tier": value} for value in (0, 6, 2.5, "3")],
    "duration: invalid": [MATCH | {"duration": -1}],
    "winner: invalid": [MATCH | {"winner": 7}],
    "user-a-postmatch-info: missing": [without(MATCH, "user-a-postmatch-info")],
    "user-a-postmatch-info: invalid": [MATCH | {"user-a-postmatch-info": "x"}],
    "user-b-postmatch-info: invalid": [MATCH | {"user-b-postmatch-info": None}],
    "user-b-postmatch-info.extra: unknown": [
        MATCH | {"user-b-postmatch-info": POST | {"extra": 1}}
    ],
    "user-a-postmatch-info.device: missing": [
        MATCH | {"user-a-postmatch-info": without(POST, "device")}
    ],
    "user-b-postmatch-info.platform: invalid": [
        MATCH | {"user-b-postmatch-info": POST | {"platform": "x" * 11}}
    ],
    "user-a-postmatch-info.level-after-match: invalid": [
        MATCH | {"user-a-postmatch-info": POST | {"level-after-match": value}}
        for value in (-1, 1.0, "1")
    ],
    "purchase_value: invalid": [
        PURCHASE | {"purchase_value": value} for value in (-0.01, "4.99", None)
    ],
    "user-a-postmatch-info: unknown": [INIT | {"user-a-postmatch-info": POST}],
}
NOT_OBJECTS = ["{bad", "", "[1]", '"text"', "5", "null", None]


def frame(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "event_json string")


def test_valid_payloads(spark):
    rows = validate_events(frame(spark, map(json.dumps, VALID))).collect()
    assert [row["event_json"] for row in rows if not row["is_valid"]] == []
    assert all(row["violations"] == [] for row in rows)


def test_invalid_payloads(spark):
    cases = [(json.dumps(e), label) for label, events in INVALID.items() for e in events]
    checked = validate_events(spark.createDataFrame(cases, "event_json string, label string"))
    wrong = [r for r in checked.collect() if r["is_valid"] or r["violations"] != [r["label"]]]
    assert wrong == []


def test_both_checks_agree(spark):
    """The cheap test and the explanation must come to the same verdict."""
    events = VALID + [event for group in INVALID.values() for event in group]
    for row in validate_events(frame(spark, map(json.dumps, events))).collect():
        assert row["is_valid"] == (row["violations"] == []), row


def test_several_violations(spark):
    event = without(INIT, "country") | {"time": -1, "extra": 1}
    [row] = validate_events(frame(spark, [json.dumps(event)])).collect()
    assert sorted(row["violations"]) == ["country: missing", "extra: unknown", "time: invalid"]


def test_not_objects(spark):
    for row in validate_events(frame(spark, NOT_OBJECTS)).collect():
        assert not row["is_valid"] and row["event_type"] is None
        assert row["violations"] == ["payload: not a JSON object"]


def test_valid_events_keeps_columns(spark):
    df = valid_events(frame(spark, [json.dumps(INIT), "{bad"]))
    assert df.columns == ["event_json"] and df.count() == 1


def test_summary_and_observed_counters(spark):
    validated = validate_events(frame(spark, [json.dumps(INIT), json.dumps(INVALID["time: missing"][0]), "{"]))
    rows = {row["event_type"]: row[1:] for row in validation_summary(validated).collect()}
    assert rows == {"init": (2, 1, 1), None: (1, 0, 1)}
    counters = Observation()
    observe_validity(validated, counters).collect()
    assert counters.get == {"generated": 3, "valid": 1, "invalid": 2, "untimed": 0}


@pytest.mark.parametrize(
    "topic,expected",
    [(None, ["init_events", "purchase_events"]), ("all", ["all"] * 4)],
)
def test_routing(spark, topic, expected):
    texts = [json.dumps(INIT), json.dumps(PURCHASE), '{"event-type":"login"}', "{bad"]
    rows = route_topics(frame(spark, texts), topic=topic).collect()
    assert [row["topic"] for row in rows] == expected


def test_drop_unparseable(spark):
    kept = drop_unparseable(frame(spark, ['{"a":1}', "[1]", "{bad", None]))
    assert [row["event_json"] for row in kept.collect()] == ['{"a":1}', "[1]"]
