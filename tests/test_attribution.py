from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan
from eventlake.operators.attribution import (
    LOOKBACK_SECONDS as DAY,
    enrich,
    enrich_latest,
    init_multiplicity,
)
from eventlake.operators.minute import minute_matches_by_country, minute_purchases_by_country

NOON = 1_706_529_600  # a second well inside a look-back bucket


def events(spark, rows):
    """(user, second, value) -> purchases"""
    return spark.createDataFrame(
        [(user, None if s is None else s * 1000, float(v)) for user, s, v in rows],
        "`user-id` string, time bigint, purchase_value double",
    )


def inits(spark, rows):
    """(user, second, country) -> inits"""
    return spark.createDataFrame(
        [(user, None if s is None else s * 1000, country) for user, s, country in rows],
        "`user-id` string, time bigint, country_name string",
    )


def countries(df):
    found = Counter()
    for row in df.collect():
        assert (row["purchase_value"], row["country_name"]) not in found
        found[row["purchase_value"], row["country_name"]] = row["copies"]
    return found


def brute_force(event_rows, init_rows, lookback=DAY):
    result = Counter()
    for user, second, value in event_rows:
        seen = [
            country
            for other, at, country in init_rows
            if None not in (user, second, at)
            and user == other
            and second - lookback <= at <= second
        ]
        for country in seen or [None]:
            result[float(value), country] += 1
    return result


@pytest.mark.parametrize(
    "at,country",
    [(0, "US"), (-DAY, "US"), (-DAY - 1, None), (1, None), (-1, "US"), (-DAY + 1, "US")],
)
@pytest.mark.parametrize("base", [NOON, NOON - NOON % DAY, NOON - NOON % DAY - 1])
def test_interval_bounds_are_inclusive(spark, base, at, country):
    df = enrich(events(spark, [("u", base, 1)]), inits(spark, [("u", base + at, "US")]))
    assert countries(df) == {(1.0, country): 1}


def test_fan_out_and_nulls(spark):
    purchase = [("u", NOON, 1), ("v", NOON, 2), (None, NOON, 3), ("u", None, 4)]
    seen = [("u", NOON, "US"), ("u", NOON, "US"), ("u", NOON - 5, "UK"), (None, NOON, "DE")]
    seen.append(("v", NOON, None))
    df = enrich(events(spark, purchase), inits(spark, seen))
    assert countries(df) == {
        (1.0, "US"): 2,
        (1.0, "UK"): 1,
        (2.0, None): 1,
        (3.0, None): 1,
        (4.0, None): 1,
    }


@pytest.mark.parametrize("seed", range(3))
def test_brute_force_with_a_hot_user(spark, seed):
    rng = random.Random(seed)

    def user():
        return "hot" if rng.random() < 0.4 else f"u{rng.randrange(5)}"

    lookback = 600
    span = NOON, NOON + 4 * lookback
    event_rows = [(user(), rng.randint(*span), i) for i in range(200)]
    init_rows = [(user(), rng.randint(*span), rng.choice(["US", "UK", None])) for _ in range(200)]
    left, right = events(spark, event_rows), inits(spark, init_rows)
    expected = brute_force(event_rows, init_rows, lookback)
    assert countries(enrich(left, right, lookback=lookback)) == expected

    latest = {}
    for name, second, value in event_rows:
        reach = [
            (at, country or "")
            for other, at, country in init_rows
            if name == other and second - lookback <= at <= second
        ]
        latest[float(value)] = max(reach)[1] or None if reach else None
    as_of = enrich_latest(left, right, lookback=lookback)
    assert {r["purchase_value"]: r["country_name"] for r in as_of.collect()} == latest

    gold = minute_purchases_by_country(left, right, lookback=lookback, exact=True)
    totals, revenue = Counter(), Counter()
    for (value, country), copies in expected.items():
        totals[country] += copies
        revenue[country] += copies * value
    rows = gold.collect()
    for country in totals:
        mine = [row for row in rows if row["country_name"] == country]
        assert sum(row["purchase_count"] for row in mine) == totals[country]
        assert sum(row["country_revenue"] for row in mine) == pytest.approx(revenue[country])


def test_a_hot_user_collapses_before_the_window(spark):
    """Many rows of one user and second reach the time line as one row each."""
    left = events(spark, [("hot", NOON, 1)] * 500)
    right = inits(spark, [("hot", NOON, "US")] * 300)
    [row] = init_multiplicity(left, right).collect()
    assert (row["copies"], row["country_name"]) == (300, "US")
    [gold] = minute_purchases_by_country(left, right, exact=True).collect()
    assert (gold["purchase_count"], gold["distinct_users"]) == (150_000, 1)


def test_events_without_a_user_spread_over_tasks(spark):
    left = events(spark, [(None, NOON + i, i) for i in range(200)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = enrich(left, inits(spark, [("u", NOON, "US")]))
        tasks = df.select(F.spark_partition_id().alias("task")).distinct().count()
        assert countries(df) == {(float(i), None): 1 for i in range(200)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks > 1


def test_batch_plan_forms_no_pairs(spark):
    left = events(spark, [("u", NOON, 1)])
    text = plan(minute_purchases_by_country(left, inits(spark, [("u", NOON, "US")])))
    assert "Join" not in text and "CartesianProduct" not in text


def test_enriched_rows_are_not_repeated(spark):
    left = events(spark, [("hot", NOON, 1)])
    df = enrich(left, inits(spark, [("hot", NOON - i, "US") for i in range(500)]))
    assert "sequence" not in plan(df)
    assert countries(df) == {(1.0, "US"): 500}


def test_both_sides(spark):
    matches = spark.createDataFrame(
        [("a", "b", NOON * 1000)], "`user-a` string, `user-b` string, time bigint"
    )
    seen = inits(spark, [("a", NOON, "US"), ("b", NOON, "UK"), ("b", NOON - 1, "UK")])

    def counts(**options):
        gold = minute_matches_by_country(matches, seen, exact=True, **options)
        return {row["country_name"]: row["match_count"] for row in gold.collect()}

    assert counts() == {"US": 1}
    assert counts(sides=("user-a", "user-b")) == {"US": 1, "UK": 2}
