"""Distinct users from united bitmaps."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan
from eventlake.operators import user_rollup
from eventlake.operators.daily import daily_users, daily_users_by_country
from eventlake.plans import queries
from eventlake.sources.tables import read_table, scratch_dir

BASE = 1_704_067_200
INIT = "time bigint, `user-id` string, country_name string, platform string"


def inits(spark, days, rows=300, users=40, seed=1):
    rng = random.Random(f"{seed}{days}")
    data = [
        (
            (BASE + 86400 * rng.choice(days) + rng.randrange(86400)) * 1000,
            rng.choice([None, *(f"u{i}" for i in range(users))]),
            rng.choice(["US", "UK", None]),
            rng.choice(["IOS", "WEB"]),
        )
        for _ in range(rows)
    ]
    return spark.createDataFrame(data, INIT)


@pytest.fixture
def paths(spark):
    root = scratch_dir(spark, "rollup")
    return f"{root}/rollup", f"{root}/dictionary"


def same(found, expected):
    expected = expected.drop("aggregation_timestamp").select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def counted(spark, df):
    """The rows, and a count of how often one of them was computed."""
    times = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(value):
        times.add(1)
        return value

    return df.withColumn("user-id", passed("user-id")), times


def test_inits_are_computed_once(spark, paths):
    for days in ([0, 1], [2]):
        part = inits(spark, days)
        rows, times = counted(spark, part)
        user_rollup.write_user_rollup(spark, rows, *paths)
        assert times.value == part.count()


def test_the_query_parses_each_event_once(spark, sf_dir, monkeypatch):
    made, silver = [], queries._silver
    monkeypatch.setattr(queries, "_silver", lambda *args: made.append(counted(spark, silver(*args))) or made[-1][0])
    queries.QUERIES["rollup_users_range"](spark, sf_dir).collect()
    [(_, times)] = made
    assert times.value == silver(spark, sf_dir, "init").count()


def test_days_countries_and_ranges(spark, paths):
    everything = None
    for days in ([0, 1], [2], [3, 4, 5]):
        part = inits(spark, days, users=40 + 20 * days[0])
        everything = part if everything is None else everything.unionByName(part)
        user_rollup.write_user_rollup(spark, part, *paths)
    rollup = read_table(spark, paths[0])
    dates = everything.select(F.min("time"), F.max("time")).first()
    assert dates[1] - dates[0] > 86_400_000
    same(user_rollup.users_from_rollup(rollup), daily_users(everything, "2024-01-01", "2024-01-06"))
    same(user_rollup.users_from_rollup(rollup, ("event_date", "country_name")), daily_users_by_country(everything))
    ranged = everything.filter(F.col("time").between((BASE + 86400) * 1000, (BASE + 4 * 86400) * 1000 - 1))
    for by in ((), ("platform",), ("country_name", "platform")):
        expected = ranged.groupBy(*by).agg(F.count_distinct("user-id").alias("distinct_users"))
        same(user_rollup.users_from_rollup(rollup, by, "2024-01-02", "2024-01-04"), expected)


def test_numbers_are_dense_and_never_change(spark, paths):
    first = user_rollup.add_users(spark, inits(spark, [0], users=30), paths[1])
    before = {row["user"]: row["number"] for row in first.collect()}
    again = user_rollup.add_users(spark, inits(spark, [0], users=30), paths[1])
    assert {row["user"]: row["number"] for row in again.collect()} == before
    more = user_rollup.add_users(spark, inits(spark, [1], users=90), paths[1]).collect()
    after = {row["user"]: row["number"] for row in more}
    assert len(more) == len(after) > len(before) and after.items() >= before.items()
    assert sorted(after.values()) == list(range(1, len(after) + 1))


def test_a_repeated_day_replaces_itself(spark, paths):
    part = inits(spark, [0, 1])
    for _ in range(2):
        user_rollup.write_user_rollup(spark, part, *paths)
    corrected = part.filter("time < %d" % ((BASE + 86400) * 1000)).limit(5)
    user_rollup.write_user_rollup(spark, corrected, *paths)
    found = user_rollup.users_from_rollup(read_table(spark, paths[0]))
    kept = part.filter("time >= %d" % ((BASE + 86400) * 1000)).unionByName(corrected)
    same(found, daily_users(kept, "2024-01-01", "2024-01-02"))


def test_users_of_several_blocks(spark, paths):
    many = spark.range(80_000).select(
        F.lit(BASE * 1000).alias("time"), F.format_string("u%d", F.col("id") % 70_000).alias("user-id"),
        F.when(F.col("id") % 2 == 0, "US").otherwise("UK").alias("country_name"), F.lit("WEB").alias("platform"),
    )
    user_rollup.write_user_rollup(spark, many, *paths)
    rollup = read_table(spark, paths[0])
    assert rollup.count() == 2 * 3
    assert user_rollup.users_from_rollup(rollup, ()).first()[0] == 70_000


def test_only_the_days_asked_for_are_read(spark, paths):
    user_rollup.write_user_rollup(spark, inits(spark, [0, 1, 2]), *paths)
    text = plan(user_rollup.users_from_rollup(read_table(spark, paths[0]), ("country_name",), "2024-01-02"))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "event_date" in filters and "dictionary" not in text


def test_no_inits(spark, paths):
    user_rollup.write_user_rollup(spark, inits(spark, [0], rows=3), *paths)
    user_rollup.write_user_rollup(spark, inits(spark, [0], rows=3).limit(0), *paths)
    assert read_table(spark, paths[0]).count() > 0
