"""Distinct users of windows, in batch and as streams; sliding windows from panes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import differences, duckdb_tables
from eventlake.operators import minute
from eventlake.plans.oracle import ORACLE
from eventlake.plans.queries import QUERIES
from eventlake.sources.tables import read_table, read_table_stream, scratch_dir
from eventlake.streaming import jobs, sinks, supervise
from eventlake.streaming.sinks import AVAILABLE_NOW

BASE = 1_704_067_200
MATCH = "time bigint, `user-a` string, `user-b` string"
PURCHASE = "time bigint, `user-id` string, purchase_value double"


@pytest.fixture
def lake(spark):
    return jobs.Lake(scratch_dir(spark, "lake"))


def add(spark, lake, table, rows, schema):
    rows = [((BASE + row[0]) * 1000, *row[1:]) for row in rows]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(lake.table(table))


def stream(spark, lake, table, schema, function, gold="gold-out", **reading):
    source = read_table_stream(spark, lake.table(table), schema, **reading)
    with sinks.state_settings(spark, 2):
        query = sinks.append_stream(function(source), lake.table(gold), lake.checkpoint(gold), AVAILABLE_NOW)
    supervise.await_all([query])
    return query


def gold(spark, lake):
    rows = read_table(spark, lake.table("gold-out")).drop("aggregation_timestamp").orderBy("window_start")
    return [tuple(row)[2:] for row in rows.collect()]


def sharing_a_register(spark):
    """Two users that the sketch takes for one."""
    pairs = spark.range(4000).select((F.col("id") % 2000).alias("pair"), F.format_string("u%d", "id").alias("user"))
    taken = pairs.groupBy("pair").agg(F.approx_count_distinct("user").alias("n"), F.collect_set("user").alias("users"))
    return sorted(taken.filter("n = 1").orderBy("pair").first()["users"])


def test_users_that_share_a_register_are_two(spark, lake):
    one, other = sharing_a_register(spark)
    rows = [(0, "x", one), (1, "x", other), (2, None, other), (10_000, "z", "z")]
    add(spark, lake, "silver-match", rows, MATCH)
    batch = minute.minute_matches(read_table(spark, lake.table("silver-match")))
    expected = (3, 1, 2)
    assert tuple(batch.orderBy("window_start").first())[2:5] == expected
    sketch = minute.minute_matches(read_table(spark, lake.table("silver-match")), exact=False)
    assert tuple(sketch.orderBy("window_start").first())[2:5] == (3, 1, 1)
    stream(spark, lake, "silver-match", MATCH, minute.minute_matches)
    assert gold(spark, lake) == [expected]


def test_a_user_on_both_sides_of_a_restart_counts_once(spark, lake):
    add(spark, lake, "silver-purchase", [(0, "a", 1.0), (1, "b", 2.0)], PURCHASE)
    stream(spark, lake, "silver-purchase", PURCHASE, minute.minute_purchases)
    add(spark, lake, "silver-purchase", [(2, "a", 4.0), (3, "c", None), (4, None, 8.0)], PURCHASE)
    stream(spark, lake, "silver-purchase", PURCHASE, minute.minute_purchases)
    assert gold(spark, lake) == []
    add(spark, lake, "silver-purchase", [(10_000, "z", 1.0)], PURCHASE)
    stream(spark, lake, "silver-purchase", PURCHASE, minute.minute_purchases)
    assert gold(spark, lake) == [(5, 15.0, 3)]


def test_state_holds_the_users_of_open_windows(spark, lake):
    """Three windows an hour apart, ten users and a hundred rows each: closed windows leave nothing."""
    for hour in range(3):
        rows = [(3600 * hour + i % 60, f"u{i % 10}", 1.0) for i in range(100)]
        add(spark, lake, "silver-purchase", rows, PURCHASE)
    query = stream(spark, lake, "silver-purchase", PURCHASE, minute.minute_purchases, max_files_per_trigger=1)
    states = [[op.numRowsTotal for op in p.stateOperators] for p in query.recentProgress]
    assert max(map(sum, states)) <= 2 * 10 + 2 and sum(states[-1]) <= 10
    assert gold(spark, lake) == [(100, 100.0, 10)] * 2


def test_streams_equal_the_batch_for_any_split(spark, lake):
    rng = random.Random(2)
    rows = [(i * 7, f"u{rng.randrange(5)}", f"v{rng.randrange(5)}") for i in range(300)]
    cuts = [0, *sorted(rng.sample(range(300), 3)), 300]
    for start, end in zip(cuts, cuts[1:]):
        add(spark, lake, "silver-match", rows[start:end], MATCH)
    stream(spark, lake, "silver-match", MATCH, minute.minute_matches, max_files_per_trigger=1)
    batch = minute.minute_matches(read_table(spark, lake.table("silver-match"))).drop("aggregation_timestamp")
    expected = [tuple(row)[2:] for row in batch.orderBy("window_start").collect()]
    found = gold(spark, lake)
    assert found == expected[: len(found)] and len(found) > 20


SLIDES = [("5 minutes", "1 minute", True), ("1 hour", "20 minutes", True), ("5 minutes", "2 minutes", False)]


@pytest.mark.parametrize("window, slide, panes", SLIDES)
def test_sliding_windows_equal_windows_over_rows(spark, window, slide, panes):
    rng = random.Random(7)
    rows = [((BASE + rng.randrange(9000)) * 1000, f"u{rng.randrange(6)}", 1.0, rng.choice("ab")) for _ in range(800)]
    events = minute.with_event_time(spark.createDataFrame(rows, PURCHASE + ", country_name string"))
    sums = {"n": F.lit(1), "revenue": F.col("purchase_value")}
    found = minute._windowed(events, sums, {"users": "user-id"}, window, slide, "country_name")
    plain = events.groupBy(F.window("event_timestamp", window, slide), "country_name").agg(
        F.count("*").alias("n"), F.sum("purchase_value"), F.count_distinct("user-id")
    )
    plain = plain.select("window.start", "window.end", "country_name", *plain.columns[2:])
    order = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert order(found.drop("aggregation_timestamp")) == order(plain)
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    spread = next(i for i, line in enumerate(lines) if "Expand" in line)
    # What is spread over windows are panes added up by user, not rows.
    assert any("Aggregate" in line for line in lines[spread:]) == panes
    assert minute._in_panes(window, slide) == panes


def test_durations():
    assert not minute._in_panes("1 minute", None)
    assert not minute._in_panes("interval 5 minutes", "1 minute")


STREAMS = [name for name in QUERIES if name.startswith("minute_") and name.endswith("_stream")]


@pytest.mark.parametrize("name", STREAMS)
def test_streams_at_the_scale_of_the_correctness_run(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, sf_dir), duckdb_tables(sf_dir), ORACLE[name]) is None
