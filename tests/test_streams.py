from __future__ import annotations

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import plan
from eventlake import __main__ as command
from eventlake.functions.event_time import event_date
from eventlake.operators import attribution, minute
from eventlake.operators.bronze import to_bronze_legacy, with_constant
from eventlake.operators.daily import init_on_days
from eventlake.plans.event_types import default_event_types
from eventlake.plans.event_feed import kafka_rows, stream_events
from eventlake.schemas import BRONZE_DDL
from eventlake.sources.tables import read_table, read_table_stream, scratch_dir
from eventlake.streaming import jobs, sinks, supervise
from eventlake.streaming.progress import join_state, logged_progress, recent_progress
from eventlake.streaming.sinks import AVAILABLE_NOW

PURCHASE = "time bigint, `user-id` string, purchase_value double"
BASE = 1_704_067_200


def run(df, lake, table, **settings):
    with sinks.state_settings(df.sparkSession, 2):
        query = sinks.append_stream(
            df, lake.table(table), lake.checkpoint(table), AVAILABLE_NOW, **settings
        )
    supervise.await_all([query])
    return query


def add(spark, path, seconds, users=("u",)):
    rows = [((BASE + s) * 1000, users[s % len(users)], 1.0) for s in seconds]
    spark.createDataFrame(rows, PURCHASE).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def lake(spark):
    return jobs.Lake(scratch_dir(spark, "lake"))


def test_late_rows_are_dropped_and_counted(spark, lake):
    """Within one run: a row is late against the watermark of the batch before."""
    source = lake.table("silver-purchase")
    for batch in ([0, 3600], [7200], [30, 7260]):
        add(spark, source, batch)
    stream = read_table_stream(spark, source, PURCHASE, max_files_per_trigger=1)
    query = run(minute.minute_purchases(stream), lake, "gold-minute-purchases")
    progress = recent_progress(spark, query)
    assert progress.agg(F.sum("late_rows_dropped")).first()[0] == 1
    gold = read_table(spark, lake.table("gold-minute-purchases"))
    assert [row["purchase_count"] for row in gold.orderBy("window_start").collect()] == [1, 1]


def test_restart_neither_loses_nor_repeats(spark, lake):
    source = lake.table("silver-purchase")
    for hour in range(3):
        add(spark, source, [hour * 3600, hour * 3600 + 10])
        stream = read_table_stream(spark, source, PURCHASE)
        run(minute.minute_purchases(stream), lake, "gold-minute-purchases")
    gold = read_table(spark, lake.table("gold-minute-purchases"))
    rows = gold.orderBy("window_start").collect()
    assert [row["purchase_count"] for row in rows] == [2, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_result_does_not_depend_on_the_split(spark, seed):
    """In-order rows give the same windows however they are cut into micro-batches."""
    rng = random.Random(seed)
    seconds = sorted(rng.randrange(0, 50 * 3600) for _ in range(60))
    init_seconds = sorted(rng.randrange(0, 50 * 3600) for _ in range(40))
    cuts = sorted(rng.sample(range(1, 50), 2))
    results = []
    for bounds in ([], cuts):
        lake = jobs.Lake(scratch_dir(spark, "split"))
        edges = [0, *[c * 3600 for c in bounds], 50 * 3600]
        for low, high in zip(edges, edges[1:]):
            add(spark, lake.table("silver-purchase"), [s for s in seconds if low <= s < high], "ab")
            part = [
                ((BASE + s) * 1000, "ab"[s % 2], "US")
                for s in init_seconds
                if low <= s < high
            ]
            spark.createDataFrame(
                part, "time bigint, `user-id` string, country_name string"
            ).coalesce(1).write.mode("append").parquet(lake.table("silver-init"))
        purchases = read_table_stream(
            spark, lake.table("silver-purchase"), max_files_per_trigger=1
        )
        inits = read_table_stream(spark, lake.table("silver-init"), max_files_per_trigger=1)
        gold = minute.minute_purchases_by_country(purchases, inits)
        run(gold, lake, "gold-by-country")
        rows = read_table(spark, lake.table("gold-by-country")).drop("aggregation_timestamp")
        results.append(sorted(map(str, rows.collect())))
    assert results[0] == results[1] and results[0]


def test_stream_equals_batch_for_closed_windows(spark, lake):
    source = lake.table("silver-purchase")
    add(spark, source, [0, 30, 90, 4000, 9000])
    run(minute.minute_purchases(read_table_stream(spark, source, PURCHASE)), lake, "gold-x")
    streamed = read_table(spark, lake.table("gold-x")).drop("aggregation_timestamp")
    batch = minute.minute_purchases(read_table(spark, source)).drop("aggregation_timestamp")
    closed = batch.filter(F.col("window_end") <= F.timestamp_seconds(F.lit(BASE + 9000 - 600)))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, closed.collect()))


def test_shared_silver_and_tables_by_type_agree(spark, sf_dir, lake):
    bronze = jobs.run_bronze(kafka_rows(stream_events(spark, sf_dir)), lake, AVAILABLE_NOW)
    supervise.await_all([bronze])
    [query] = jobs.run_silver(spark, lake, AVAILABLE_NOW)
    supervise.await_all([query])
    other = jobs.Lake(lake.root + "-other", by_day=False, files_per_batch=None, shared_silver=False)
    lake.read(spark, "bronze").drop("event_date").write.parquet(other.table("bronze"))
    supervise.await_all(jobs.run_silver(spark, other, AVAILABLE_NOW))
    [counted] = [p.observedMetrics["silver"] for p in query.recentProgress if p.numInputRows]
    for name in default_event_types():
        expected = other.read(spark, f"silver-{name}")
        actual = lake.read(spark, f"silver-{name}").drop("event_date")
        assert actual.dtypes == expected.dtypes
        assert len(actual.columns) == {"init": 18, "match": 27, "purchase": 18}[name]
        drop = ("ingestion_timestamp", "processing_timestamp")
        assert actual.drop(*drop).exceptAll(expected.drop(*drop)).isEmpty()
        assert actual.count() == expected.count() == counted[f"{name}_rows"]
        assert counted[f"{name}_untimed"] == 0
    for of in (lake, other):
        supervise.await_all(jobs.run_gold(spark, of, AVAILABLE_NOW, state_partitions=2))
    for name in ("minute-purchases", "minute-matches", "minute-purchases-by-country"):
        golds = [of.read(spark, f"gold-{name}").drop("aggregation_timestamp") for of in (lake, other)]
        found = [sorted(map(str, gold.collect())) for gold in golds]
        assert found[0] == found[1] and found[0]


def write_bronze(spark, lake, *offsets, kinds=("init",)):
    payload = '{"event-type":"%s","time":%d,"user-id":"u"}'
    data = [(payload % (kind, BASE * 1000 + n), None, None, "t", 0, n) for n in offsets for kind in kinds]
    spark.createDataFrame(data, BRONZE_DDL).coalesce(1).write.mode("append").parquet(lake.table("bronze"))


def test_shared_silver_goes_on_from_its_checkpoint(spark, lake):
    """No row is lost or repeated over restarts, in the table or for its readers."""
    for offsets, expected in (((1, 2), [1, 2]), ((), [1, 2]), ((3,), [1, 2, 3])):
        if offsets:
            write_bronze(spark, lake, *offsets, kinds=("init", "in-app-purchase"))
        supervise.await_all(jobs.run_silver(spark, lake, AVAILABLE_NOW))
        run(lake.read_stream(spark, "silver-init").select("time"), lake, "gold-copied")
        for found in (lake.read(spark, "silver-init"), lake.read(spark, "gold-copied")):
            assert sorted(row["time"] - BASE * 1000 for row in found.collect()) == expected


def test_files_of_an_unfinished_batch_are_not_read(spark, lake):
    write_bronze(spark, lake, 1, 2)
    supervise.await_all(jobs.run_silver(spark, lake, AVAILABLE_NOW))
    folder = lake.table("silver") + "/silver_table=init/event_date=2024-01-01"
    committed = lake.read(spark, "silver-init").drop("event_date")
    committed.write.mode("append").parquet(folder)  # As a task that was lost might leave it.
    assert lake.read(spark, "silver-init").count() == 2


def test_a_new_checkpoint_over_a_table_is_refused(spark, lake):
    write_bronze(spark, lake, 1)
    supervise.await_all(jobs.run_silver(spark, lake, AVAILABLE_NOW))
    stream = read_table_stream(spark, lake.table("bronze"), BRONZE_DDL)
    with pytest.raises(ValueError, match="another checkpoint"):
        sinks.append_stream(stream, lake.table("silver"), lake.checkpoint("new"), AVAILABLE_NOW)


def test_steps_of_one_type_never_see_the_others(spark):
    from eventlake.functions import rules
    from eventlake.operators.silver import parse_events, to_shared_silver, to_shared_values, to_silver, to_kafka_value
    from eventlake.plans.event_types import EventType

    rules.column_rule("number")(lambda source: source.cast("int"))  # Fails on what is no number.
    step = {"field": "number", "type": "number", "params": {"source_field": "user-id"}}
    place = {"field": "country", "type": "mapping", "params": {"mapping": {"US": "x"}, "default": "none"}}
    kinds = [
        EventType("init", "init", "init", [place]),
        EventType("buy", "in-app-purchase", "buys", [step]),
        EventType("again", "init", "again"),
    ]
    payloads = [
        '{"event-type":"init","time":1,"user-id":"abc","country":"US"}',
        '{"event-type":"in-app-purchase","time":2,"user-id":"12"}',
        '{"event-type":"other","time":3}',
        "{bad",
    ]
    bronze = spark.createDataFrame([(p, None, None, "t", 0, 0) for p in payloads], BRONZE_DDL)
    try:
        shared = to_shared_silver(bronze, kinds)
        for kind in kinds:
            expected = to_silver(bronze, kind).drop("processing_timestamp")
            found = shared.filter(F.col("silver_table") == kind.silver_table).select(*expected.columns)
            assert found.collect() == expected.collect()
        assert shared.count() == 3
        values = sorted(row["value"].split(',"processing')[0] for row in to_shared_values(bronze, kinds).collect())
        apart = [to_kafka_value(to_silver(bronze, kind)).collect() for kind in kinds]
        assert values == sorted(row["value"].split(',"processing')[0] for rows in apart for row in rows)
        clash = {"field": "country", "type": "mapping", "params": {"mapping": {"US": 1}, "default": 2}}
        with pytest.raises(ValueError, match="disagree"):
            to_shared_silver(bronze, [kinds[0], EventType("x", "in-app-purchase", "x", [clash])])
    finally:
        rules.reset_rules()
    text = plan(to_shared_silver(bronze, kinds))
    assert text.count("from_json(") == plan(parse_events(bronze)).count("from_json(")


def test_custom_transform_hook(spark, sf_dir, lake):
    query = jobs.run_bronze(
        kafka_rows(stream_events(spark, sf_dir)),
        lake,
        AVAILABLE_NOW,
        transform=lambda kafka: with_constant(to_bronze_legacy(kafka), "custom_field", "value"),
    )
    supervise.await_all([query])
    df = read_table(spark, lake.table("bronze"))
    assert {"kafka_key", "value", "topic", "custom_field", "ingestion_timestamp"} <= set(df.columns)


def test_failure_of_one_query_ends_the_group(spark, lake):
    healthy = spark.readStream.format("rate").load()
    failing = healthy.select(F.raise_error(F.lit("broken on purpose")).alias("x"), "value")
    queries = [
        sinks.append_stream(df, lake.table(name), lake.checkpoint(name), "1 second")
        for name, df in (("gold-ok", healthy), ("gold-bad", failing))
    ]
    with pytest.raises(StreamingQueryException):
        supervise.await_any(queries, poll_seconds=0.2)
    assert not any(query.isActive for query in queries)


def test_failed_start_stops_earlier_queries(spark, lake):
    started = []

    def first():
        df = spark.readStream.format("rate").load()
        query = sinks.append_stream(df, lake.table("gold-a"), lake.checkpoint("gold-a"), "1 second")
        started.append(query)
        return query

    def second():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        supervise.start_all([first, second])
    assert not started[0].isActive


def test_disabled_kafka_output(spark):
    df = spark.readStream.format("rate").load()
    assert sinks.publish_stream(df, "host:9092", "topic", "/tmp/x", enabled=False) is None


def test_state_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sinks.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_no_micro_batch_is_lost(spark, lake):
    """More micro-batches than Spark remembers."""
    source, log = lake.table("silver-purchase"), lake.table("progress")
    rows = [((BASE + s) * 1000, "u", 1.0) for s in range(110)]
    one_each = spark.createDataFrame(rows, PURCHASE).write.option("maxRecordsPerFile", 1)
    one_each.parquet(source)
    files = len(read_table(spark, source).inputFiles())
    stream = read_table_stream(spark, source, PURCHASE, max_files_per_trigger=1)
    with logged_progress(spark, log):
        query = run(stream, lake, "gold-copy", name="copy")
    found = read_table(spark, log).filter("name = 'copy' and input_rows > 0")
    assert found.count() == files > 100 >= len(query.recentProgress)
    assert found.agg(F.sum("input_rows")).first()[0] == 110


def test_failures_are_logged(spark, lake):
    df = spark.readStream.format("rate").load()
    failing = df.select(F.raise_error(F.lit("broken on purpose")).alias("x"), "value")
    with logged_progress(spark, lake.table("progress")) as log:
        query = sinks.append_stream(failing, lake.table("gold-bad"), lake.checkpoint("gold-bad"), "1 second")
        with pytest.raises(StreamingQueryException):
            supervise.await_all([query])
    [row] = read_table(spark, log.failures).collect()
    assert row["query_id"] == str(query.id) and "broken on purpose" in row["error"]


def test_a_failure_is_seen_while_others_run(spark, lake):
    healthy = spark.readStream.format("rate").load()
    failing = healthy.select(F.raise_error(F.lit("broken on purpose")).alias("x"), "value")
    queries = [
        sinks.append_stream(df, lake.table(name), lake.checkpoint(name), "1 second")
        for name, df in (("gold-ok", healthy), ("gold-bad", failing))
    ]
    with pytest.raises(StreamingQueryException):
        supervise.await_all(queries)
    assert not any(query.isActive for query in queries)


@pytest.mark.parametrize("shared", [True, False])
def test_tables_by_day(spark, sf_dir, shared):
    lake = jobs.Lake(scratch_dir(spark, "by-day"), files_per_batch=1, shared_silver=shared)
    supervise.await_all([jobs.run_bronze(kafka_rows(stream_events(spark, sf_dir)), lake, AVAILABLE_NOW)])
    supervise.await_all(jobs.run_silver(spark, lake, AVAILABLE_NOW))
    silver = lake.read(spark, "silver-init")
    days = silver.select("event_date").distinct().count()
    files = silver.select("_metadata.file_path").distinct().count()
    assert files == days > 1
    own = event_date() != F.col("event_date")
    assert silver.filter(own).isEmpty()
    text = plan(init_on_days(silver, "2024-01-15"))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "event_date" in filters and ("silver_table" in filters) == shared
    assert jobs.run_daily(spark, lake, "2024-01-15") > 0
    first = read_table(spark, lake.table("gold-daily-users")).count()
    assert jobs.run_daily(spark, lake, "2024-01-15") == first
    assert read_table(spark, lake.table("gold-daily-users")).count() == first


def test_the_feed_is_dealt_over_all_cores(spark, sf_dir, lake):
    run(stream_events(spark, sf_dir).select(F.spark_partition_id().alias("task")), lake, "gold-tasks")
    tasks = read_table(spark, lake.table("gold-tasks"))
    assert tasks.distinct().count() == spark.sparkContext.defaultParallelism
    assert tasks.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_large_batches_of_flat_tables_are_written_by_more_tasks(spark, sf_dir):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    rows = []
    for bytes_each, enough in ((before, lambda files: files <= 2), ("10k", lambda files: files > 4)):
        flat = jobs.Lake(scratch_dir(spark, "flat"), by_day=False, files_per_batch=2)
        spark.conf.set(size, bytes_each)
        try:
            supervise.await_all([jobs.run_bronze(kafka_rows(stream_events(spark, sf_dir)), flat, AVAILABLE_NOW)])
        finally:
            spark.conf.set(size, before)
        bronze = flat.read(spark, "bronze")
        assert enough(bronze.select("_metadata.file_path").distinct().count())
        rows.append(sorted(map(str, bronze.drop("ingestion_timestamp").collect())))
    assert rows[0] == rows[1]


def test_published_rows_are_counted(spark, lake):
    source = lake.table("raw")
    good = '{"event-type":"in-app-purchase","time":%d,"purchase_value":1.5,"user-id":"u","product-id":"p"}'
    payloads = [good % 5, good % (1 << 62), "{bad", good.replace("1.5", "-1") % 5]
    payloads.append((good % 5).replace('"user-id":"u"', '"user-id":-3,"user-id":"v"'))
    spark.createDataFrame([(p,) for p in payloads], "event_json string").coalesce(1).write.parquet(source)
    query = jobs.run_publish(read_table_stream(spark, source), lake, AVAILABLE_NOW)
    supervise.await_all([query])
    published = [row["value"] for row in read_table(spark, lake.table("published")).collect()]
    assert sorted(published) == sorted([payloads[0], payloads[1], payloads[4]])
    seen = [p.observedMetrics["validity"] for p in query.recentProgress if p.numInputRows]
    assert [tuple(row) for row in seen] == [(5, 3, 2, 1)]


def test_command_line(spark, sf_dir, tmp_path, capsys):
    lake = jobs.Lake(str(tmp_path))
    supervise.await_all([jobs.run_bronze(kafka_rows(stream_events(spark, sf_dir)), lake, AVAILABLE_NOW)])
    common = ["--lake", lake.root, "--trigger", AVAILABLE_NOW]
    command.run(spark, ["silver", *common])
    command.run(spark, ["gold", *common, "--tables", "minute-purchases"])
    command.run(spark, ["daily", *common, "--first", "2024-01-15"])
    command.run(spark, ["report", *common, "--tables", "gold-daily-users"])
    shown = capsys.readouterr().out
    assert "daily rows written" in shown and "distinct_users" in shown
    with pytest.raises(SystemExit):
        command.run(spark, ["bronze", *common])


INIT = "time bigint, `user-id` string, country_name string"


def add_inits(spark, lake, rows):
    data = [((BASE + s) * 1000, user, country) for s, user, country in rows]
    df = spark.createDataFrame(data, INIT).coalesce(1)
    df.write.mode("append").parquet(lake.table("silver-init"))


def by_country(spark, lake):
    purchases = read_table_stream(spark, lake.table("silver-purchase"), PURCHASE)
    inits = read_table_stream(spark, lake.table("silver-init"), INIT)
    return run(minute.minute_purchases_by_country(purchases, inits), lake, "gold-by-country")


def test_a_user_turning_hot_between_runs_keeps_its_matches(spark, lake):
    add_inits(spark, lake, [(0, "a", "US"), (5, "b", "UK")])
    add(spark, lake.table("silver-purchase"), [10])
    by_country(spark, lake)
    add(spark, lake.table("silver-purchase"), [3600 + s for s in range(8)], "a")
    add_inits(spark, lake, [(3700, "b", "UK")])
    by_country(spark, lake)
    add(spark, lake.table("silver-purchase"), [100 * 3600], "z")
    add_inits(spark, lake, [(100 * 3600, "z", "DE")])
    by_country(spark, lake)
    gold = read_table(spark, lake.table("gold-by-country")).collect()
    found = {(row["country_name"], row["purchase_count"]) for row in gold}
    assert found == {(None, 1), ("US", 8)}


def test_state_of_a_hot_user_grows_with_seconds(spark, lake):
    add_inits(spark, lake, [(s % 20, "hot", "US") for s in range(1000)])
    add(spark, lake.table("silver-purchase"), [s % 20 for s in range(500)], ("hot",))
    query = by_country(spark, lake)
    most = max(sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress)
    assert most <= 3 * 2 * 20 + 60
    for table, rows in (("silver-purchase", PURCHASE), ("silver-init", INIT)):
        last = [((BASE + 100 * 3600) * 1000, "z", 1.0 if rows is PURCHASE else "DE")]
        spark.createDataFrame(last, rows).write.mode("append").parquet(lake.table(table))
    by_country(spark, lake)
    [row] = read_table(spark, lake.table("gold-by-country")).collect()
    assert (row["purchase_count"], row["distinct_users"]) == (262_500, 1)


def test_events_meet_inits_of_their_span_of_time_only(spark, lake):
    """A user's rows at both ends of the look-back and around the starts of spans, which are days of the feed."""
    day = 86400
    moments = [d * day + s for d in range(6) for s in (0, 1, 4000, day - 1)]
    add_inits(spark, lake, [(m, "u", "US" if m % 2 else "UK") for m in moments])
    source = lake.table("silver-purchase")
    add(spark, source, moments)
    by_country(spark, lake)
    mark = BASE + moments[-1] - 600
    batch = minute.minute_purchases_by_country(
        read_table(spark, source), read_table(spark, lake.table("silver-init"))
    ).filter(F.col("window_end") <= F.timestamp_seconds(F.lit(mark - day)))
    gold = read_table(spark, lake.table("gold-by-country"))
    found = [sorted(map(str, df.drop("aggregation_timestamp").collect())) for df in (gold, batch)]
    assert found[0] == found[1] and found[0]
    checkpoint = lake.checkpoint("gold-by-country")
    kept = join_state(spark, checkpoint)
    seconds = sorted(row[0] for row in kept.select(F.unix_seconds("_init_moment")).collect())
    assert seconds == [BASE + m for m in moments if mark - day <= BASE + m < mark]
    operator = spark.read.format("state-metadata").load(checkpoint).filter("operatorName = 'symmetricHashJoin'")
    state = spark.read.format("statestore").option("operatorId", operator.first()["operatorId"])
    keys = state.option("joinSide", "right").load(checkpoint).select("key").distinct()
    assert keys.count() == 2  # All are of one user.


def test_enriched_stream_adds_up_to_the_batch(spark, lake):
    add_inits(spark, lake, [(0, "a", "US"), (0, "a", "US"), (5, "a", "US"), (7, "a", "UK")])
    add(spark, lake.table("silver-purchase"), [6, 8, 200 * 3600], "ab")
    add_inits(spark, lake, [(200 * 3600, "z", "DE")])
    purchases, inits = lake.table("silver-purchase"), lake.table("silver-init")
    streamed = attribution.enrich(
        read_table_stream(spark, purchases, PURCHASE), read_table_stream(spark, inits, INIT)
    )
    run(streamed, lake, "gold-enriched")
    keys = ("time", "user-id", "country_name")
    found = read_table(spark, lake.table("gold-enriched")).groupBy(*keys).agg(F.sum("copies").alias("copies"))
    batch = attribution.enrich(read_table(spark, purchases), read_table(spark, inits))
    expected = batch.filter(F.col("time") < (BASE + 1000) * 1000).select(*keys, "copies")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_rows_without_a_user_are_never_kept(spark, lake):
    """A third of the purchases lacks a user: they pass unmatched, and no state holds one."""
    known = [((BASE + s) * 1000, f"u{s % 7}", 1.0) for s in range(0, 200)]
    unknown = [((BASE + s) * 1000, None, float(s)) for s in range(0, 200, 2)]
    last = [((BASE + 200 * 3600) * 1000, "z", 1.0)]
    source, inits = lake.table("silver-purchase"), lake.table("silver-init")
    spark.createDataFrame(known + unknown, PURCHASE).coalesce(1).write.parquet(source)
    add_inits(spark, lake, [(0, "u1", "US"), (3, "u2", "UK"), (3, "u2", "UK")])

    def streamed():
        left, right = read_table_stream(spark, source, PURCHASE), read_table_stream(spark, inits, INIT)
        return run(attribution.enrich(left, right), lake, "gold-enriched")

    query = streamed()
    joins = [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators]
    assert max(joins) <= len(known) + 2
    state = spark.read.format("statestore").option("joinSide", "left").load(lake.checkpoint("gold-enriched"))
    kept = state.select("value.*")
    assert kept.count() > 0 and kept.filter("`user-id` is null").isEmpty()
    out = read_table(spark, lake.table("gold-enriched"))
    assert out.filter("`user-id` is null").count() == len(unknown)
    spark.createDataFrame(last, PURCHASE).write.mode("append").parquet(source)
    add_inits(spark, lake, [(200 * 3600, "z", "DE")])
    streamed()
    keys = ("time", "user-id", "country_name", "purchase_value")
    found = read_table(spark, lake.table("gold-enriched")).groupBy(*keys).agg(F.sum("copies").alias("copies"))
    batch = attribution.enrich(read_table(spark, source), read_table(spark, inits))
    expected = batch.filter(F.col("time") < (BASE + 1000) * 1000).select(*keys, "copies")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
