"""The query catalogue: every operator over the given tables.

Each query takes ``(spark, sf_dir)``. Results leave out processing-time columns, show
timestamps without a zone and nested objects as JSON text, so that they can be
compared with the SQL in :mod:`eventlake.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlake.functions import rules
from eventlake.functions.event_time import event_date, event_timestamp
from eventlake.functions.preprocess import flatten_match
from eventlake.operators import attribution, bronze, daily, minute, silver, user_rollup, validity
from eventlake.plans import medallion, reports
from eventlake.plans.event_types import default_event_types
from eventlake.schemas import PROCESSING_TIME_COLUMNS
from eventlake.plans.event_feed import kafka_rows, read_events, stream_events
from eventlake.sources.schema_log import append_table, read_logged
from eventlake.sources.tables import read_table, scratch_dir
from eventlake.streaming.jobs import (
    Lake,
    run_bronze,
    run_daily,
    run_gold,
    run_publish,
    run_silver,
)
from eventlake.streaming.progress import join_state, logged_progress
from eventlake.streaming.sinks import (
    AVAILABLE_NOW,
    append_stream,
    state_settings,
)
from eventlake.streaming.supervise import await_all

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Arguments of the queries that take a day, a range or a start time.
DAY = "2024-01-15"
RANGE = ("2024-01-10", "2024-01-12")
SINCE = "2024-01-20 00:00:00"


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Drop processing-time columns, unzone timestamps, show structs as JSON text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in PROCESSING_TIME_COLUMNS:
            continue
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.StructType):
            column = F.to_json(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of addition in the last digits."""
    return df.withColumns({name: F.round(name, 2) for name in columns})


def _kafka(spark: SparkSession, sf_dir: str, with_invalid: bool = False) -> DataFrame:
    return kafka_rows(read_events(spark, sf_dir), with_invalid)


def _bronze(spark: SparkSession, sf_dir: str, with_invalid: bool = False) -> DataFrame:
    return bronze.to_bronze(_kafka(spark, sf_dir, with_invalid))


def _silvers(spark: SparkSession, sf_dir: str, *tables: str) -> list[DataFrame]:
    """Silver tables over the same parsed rows."""
    parsed, kinds = silver.parse_events(_bronze(spark, sf_dir)), default_event_types()
    return [silver.clean(parsed, kinds[table]) for table in tables]


def _silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _silvers(spark, sf_dir, table)[0]


def _parsed(spark: SparkSession, sf_dir: str, event_filter: str) -> DataFrame:
    return silver.of_type(silver.parse_events(_bronze(spark, sf_dir)), event_filter)


def _layers(spark: SparkSession, sf_dir: str, window: str = "1 minute") -> dict[str, DataFrame]:
    return medallion.layers(_kafka(spark, sf_dir), window)


# --- bronze and parsing ---------------------------------------------------------


@query("bronze_projection")
def _(spark, sf_dir):
    return comparable(_bronze(spark, sf_dir))


@query("bronze_projection_legacy")
def _(spark, sf_dir):
    return comparable(bronze.to_bronze_legacy(_kafka(spark, sf_dir)))


@query("parse_events")
def _(spark, sf_dir):
    return comparable(silver.parse_events(_bronze(spark, sf_dir)))


@query("drop_unparseable")
def _(spark, sf_dir):
    kept = bronze.drop_unparseable(_bronze(spark, sf_dir))
    return kept.select("kafka_offset", "event_json")


@query("event_time")
def _(spark, sf_dir):
    parsed = silver.parse_events(_bronze(spark, sf_dir))
    return comparable(
        parsed.select(
            "time",
            event_timestamp().alias("event_timestamp"),
            event_date().alias("event_date"),
        )
    )


@query("evolved_read")
def _(spark, sf_dir):
    """Bronze rows appended in two steps; the second step brings a new column."""
    path = scratch_dir(spark, "evolved")
    rows = _bronze(spark, sf_dir).select("kafka_offset", "kafka_topic", "kafka_timestamp")
    is_later = F.col("kafka_timestamp") >= F.lit(f"{DAY} 00:00:00").cast("timestamp")
    append_table(rows.filter(~is_later), path)
    append_table(bronze.with_constant(rows.filter(is_later), "source_system", "game"), path)
    return comparable(read_logged(spark, path))


# --- validation and routing -----------------------------------------------------


@query("validate_events")
def _(spark, sf_dir):
    checked = validity.validate_events(_bronze(spark, sf_dir, with_invalid=True))
    return checked.select(
        "kafka_offset",
        "event_type",
        "is_valid",
        F.array_join(F.array_sort("violations"), "; ").alias("violations"),
    )


@query("valid_events")
def _(spark, sf_dir):
    return comparable(validity.valid_events(_bronze(spark, sf_dir, with_invalid=True)))


@query("validation_summary")
def _(spark, sf_dir):
    return validity.validation_summary(
        validity.validate_events(_bronze(spark, sf_dir, with_invalid=True))
    )


@query("route_topics")
def _(spark, sf_dir):
    return validity.route_topics(_bronze(spark, sf_dir))


# --- silver ---------------------------------------------------------------------


def _silver_query(table: str) -> Query:
    return lambda spark, sf_dir: comparable(_silver(spark, sf_dir, table))


for _table in ("init", "match", "purchase"):
    QUERIES[f"silver_{_table}"] = _silver_query(_table)


@query("flatten_match")
def _(spark, sf_dir):
    flat = flatten_match(_parsed(spark, sf_dir, "match"))
    added = [name for name in flat.columns if name.startswith("user_")]
    return flat.select("time", "user-a", *added)


def _apply(spark, sf_dir, event_filter: str, *steps: dict) -> DataFrame:
    """Inits or purchases with cleaning rules applied, keyed by time and user."""
    df = rules.apply_rules(_parsed(spark, sf_dir, event_filter), steps)
    return df.select("time", "user-id", *dict.fromkeys(step["field"] for step in steps))


@query("rule_uppercase")
def _(spark, sf_dir):
    return _apply(spark, sf_dir, "init", {"field": "platform", "type": "uppercase"})


@query("rule_lowercase")
def _(spark, sf_dir):
    step = {"field": "platform_key", "type": "lowercase", "params": {"source_field": "platform"}}
    return _apply(spark, sf_dir, "init", step)


@query("rule_trim")
def _(spark, sf_dir):
    pad = {"field": "padded", "type": "pad", "params": {"source_field": "platform"}}
    trim = {"field": "trimmed", "type": "trim", "params": {"source_field": "padded"}}
    rules.column_rule("pad")(lambda source: F.concat(F.lit("  "), source, F.lit(" ")))
    return _apply(spark, sf_dir, "init", pad, trim)


@query("rule_custom")
def _(spark, sf_dir):
    rules.column_rule("user_number")(lambda source: F.substring_index(source, "_", -1))
    step = {"field": "user_number", "type": "user_number", "params": {"source_field": "user-id"}}
    return _apply(spark, sf_dir, "init", step)


# Three countries, so that most values have no entry.
_FEW_COUNTRIES = {"US": "United States", "UK": "United Kingdom", "BR": "Brazil"}


@query("rule_mapping_default")
def _(spark, sf_dir):
    params = {"source_field": "country", "mapping": _FEW_COUNTRIES, "default": "Other"}
    step = {"field": "country_name", "type": "mapping", "params": params}
    return _apply(spark, sf_dir, "init", step)


@query("rule_mapping_null")
def _(spark, sf_dir):
    params = {"source_field": "country", "mapping": _FEW_COUNTRIES}
    step = {"field": "country_name", "type": "mapping", "params": params}
    df = rules.apply_rules(_parsed(spark, sf_dir, "init"), [step])
    literal = rules.map_values(F.col("country"), _FEW_COUNTRIES)
    return df.select("time", "user-id", "country_name", literal.alias("country_literal"))


@query("rule_mapping_passthrough")
def _(spark, sf_dir):
    step = {"field": "country", "type": "mapping", "params": {"mapping": _FEW_COUNTRIES}}
    return _apply(spark, sf_dir, "init", step)


@query("silver_to_json")
def _(spark, sf_dir):
    tables = medallion.silver_tables(_bronze(spark, sf_dir))
    values = [
        silver.to_kafka_value(df.drop(*PROCESSING_TIME_COLUMNS)) for df in tables.values()
    ]
    return values[0].unionByName(values[1]).unionByName(values[2])


# --- daily gold -----------------------------------------------------------------


@query("daily_users")
def _(spark, sf_dir):
    return comparable(daily.distinct_users(_silver(spark, sf_dir, "init")))


@query("daily_users_date")
def _(spark, sf_dir):
    return comparable(daily.daily_users(_silver(spark, sf_dir, "init"), DAY))


@query("daily_users_range")
def _(spark, sf_dir):
    return comparable(daily.daily_users(_silver(spark, sf_dir, "init"), *RANGE))


@query("daily_users_by_country")
def _(spark, sf_dir):
    return comparable(daily.daily_users_by_country(_silver(spark, sf_dir, "init")))


def _daily_rerun(spark, sf_dir, overwrite: bool) -> DataFrame:
    """Write every day, then one day again, and read the table back."""
    path = scratch_dir(spark, "daily-users")
    inits = _silver(spark, sf_dir, "init")
    daily.write_daily(daily.distinct_users(inits), path)
    daily.write_daily(daily.daily_users(inits, DAY), path, overwrite=overwrite)
    return comparable(read_table(spark, path))


QUERIES["daily_users_write"] = partial(_daily_rerun, overwrite=False)
QUERIES["daily_users_overwrite"] = partial(_daily_rerun, overwrite=True)


# Inits of the earlier days reach the rollup first; the later days bring users that the dictionary lacks.
_ROLLUP_CUT = "2024-01-12"
_BY_DAY_AND_COUNTRY = ("event_date", "country_name")


def _user_rollup(
    spark, sf_dir, by: Sequence[str] = user_rollup.GROUPS, days: Sequence[str] = (None, None)
) -> DataFrame:
    """Distinct users from a rollup of bitmaps that was written in two steps, over inits laid out by day."""
    root = scratch_dir(spark, "user-rollup")
    rows = _silver(spark, sf_dir, "init").select("time", "user-id", "country_name", "platform")
    rows = rows.withColumn("event_date", event_date())
    rows.write.partitionBy("event_date").parquet(f"{root}/init")
    inits = read_table(spark, f"{root}/init", schema=rows.schema)
    earlier = F.col("event_date") < F.lit(_ROLLUP_CUT).cast("date")
    for part in (inits.filter(earlier), inits.filter(~earlier)):
        user_rollup.write_user_rollup(spark, part, f"{root}/rollup", f"{root}/dictionary")
    return user_rollup.users_from_rollup(read_table(spark, f"{root}/rollup"), by, *days)


QUERIES["rollup_users_daily"] = _user_rollup
QUERIES["rollup_users_by_country"] = partial(_user_rollup, by=_BY_DAY_AND_COUNTRY)
QUERIES["rollup_users_range"] = partial(_user_rollup, days=RANGE)
QUERIES["rollup_users_of_range"] = partial(_user_rollup, by=("country_name",), days=RANGE)


@query("daily_rows_per_date")
def _(spark, sf_dir):
    return daily.rows_per_date(daily.distinct_users(_silver(spark, sf_dir, "init")))


@query("daily_users_ranked")
def _(spark, sf_dir):
    gold = daily.distinct_users(_silver(spark, sf_dir, "init"))
    return comparable(daily.users_ranked(gold, DAY))


@query("init_rows_per_date")
def _(spark, sf_dir):
    return daily.init_rows_per_date(_silver(spark, sf_dir, "init"))


# --- attribution and windowed gold ----------------------------------------------

_ENRICHED = {
    "purchase": ("time", "user-id", "product-id", "purchase_value"),
    "match": ("time", "user-a", "user-b", "winner"),
}


def _enriched(spark, sf_dir, table: str, user: str, function) -> DataFrame:
    rows = function(*_silvers(spark, sf_dir, table, "init"), user)
    copies = [name for name in rows.columns if name == "copies"]
    return comparable(rows.select(*_ENRICHED[table], "event_timestamp", "country_name", *copies))


QUERIES["enrich_purchases"] = partial(
    _enriched, table="purchase", user="user-id", function=attribution.enrich
)
QUERIES["enrich_matches"] = partial(
    _enriched, table="match", user="user-a", function=attribution.enrich
)
QUERIES["enrich_purchases_latest"] = partial(
    _enriched, table="purchase", user="user-id", function=attribution.enrich_latest
)


def _purchases(spark, sf_dir, window: str) -> DataFrame:
    gold = minute.minute_purchases(_silver(spark, sf_dir, "purchase"), window)
    return comparable(rounded(gold, "total_revenue"))


def _matches(spark, sf_dir, window: str) -> DataFrame:
    return comparable(minute.minute_matches(_silver(spark, sf_dir, "match"), window))


def _purchases_by_country(spark, sf_dir, window: str, slide: str | None = None) -> DataFrame:
    purchases, inits = _silvers(spark, sf_dir, "purchase", "init")
    gold = minute.minute_purchases_by_country(purchases, inits, window, slide)
    return comparable(rounded(gold, "country_revenue"))


def _matches_by_country(
    spark, sf_dir, window: str, sides: Sequence[str] = ("user-a",)
) -> DataFrame:
    matches, inits = _silvers(spark, sf_dir, "match", "init")
    gold = minute.minute_matches_by_country(matches, inits, window, sides)
    return comparable(gold)


# The event rows are minutes apart, so the hourly variants are the ones that group.
for _prefix, _window in {"minute": "1 minute", "hourly": "1 hour"}.items():
    QUERIES |= {
        f"{_prefix}_purchases": partial(_purchases, window=_window),
        f"{_prefix}_matches": partial(_matches, window=_window),
        f"{_prefix}_purchases_by_country": partial(_purchases_by_country, window=_window),
        f"{_prefix}_matches_by_country": partial(_matches_by_country, window=_window),
    }
QUERIES["sliding_purchases_by_country"] = partial(
    _purchases_by_country, window="5 minutes", slide="1 minute"
)
QUERIES["minute_matches_by_country_both"] = partial(
    _matches_by_country, window="1 minute", sides=("user-a", "user-b")
)


@query("minute_revenue_by_product")
def _(spark, sf_dir):
    gold = minute.minute_revenue_by_product(_silver(spark, sf_dir, "purchase"))
    return comparable(rounded(gold, "product_revenue"))


@query("minute_match_players")
def _(spark, sf_dir):
    return comparable(minute.minute_match_players(_silver(spark, sf_dir, "match")))


@query("minute_purchases_since")
def _(spark, sf_dir):
    gold = minute.minute_purchases(_silver(spark, sf_dir, "purchase"))
    return comparable(rounded(minute.minute_rows_since(gold, SINCE), "total_revenue"))


# --- reports --------------------------------------------------------------------


@query("layer_counts")
def _(spark, sf_dir):
    """Every table is computed once and written; the counts read the tables."""
    root = scratch_dir(spark, "layers")
    return reports.row_counts(medallion.written_layers(spark, _kafka(spark, sf_dir), root))


def _report(table: str, title: str, *round_columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = reports.REPORTS[table][title](_layers(spark, sf_dir)[table])
        return comparable(rounded(df, *round_columns) if round_columns else df)

    return run


QUERIES |= {
    "report_bronze_by_topic": _report("bronze", "events by topic"),
    "report_init_by_platform": _report("silver-init", "events by platform"),
    "report_init_by_country": _report("silver-init", "events by country"),
    "report_match_by_platform": _report("silver-match", "player A platforms"),
    "report_total_revenue": _report("silver-purchase", "total revenue", "total_revenue"),
    "report_revenue_by_product": _report("silver-purchase", "revenue by product", "revenue"),
    "report_daily_users": _report("gold-daily-users", "daily users"),
    "report_minute_purchases": _report("gold-minute-purchases", "windows", "total_revenue"),
    "report_minute_matches": _report("gold-minute-matches", "windows"),
    "report_top_countries_revenue": _report(
        "gold-minute-purchases-by-country", "top countries by revenue", "total_revenue"
    ),
    "report_top_countries_matches": _report(
        "gold-minute-matches-by-country", "top countries by matches"
    ),
    "report_purchases_country": _report(
        "gold-minute-purchases-by-country", "windows", "country_revenue"
    ),
    "report_matches_country": _report("gold-minute-matches-by-country", "windows"),
}


@query("report_platform_country")
def _(spark, sf_dir):
    return reports.count_by(_silver(spark, sf_dir, "init"), "platform", "country_name")


@query("report_top_users")
def _(spark, sf_dir):
    return reports.top_by_count(_silver(spark, sf_dir, "init"), "user-id")


@query("report_hourly_activity")
def _(spark, sf_dir):
    inits = _silver(spark, sf_dir, "init").withColumn("event_timestamp", event_timestamp())
    return comparable(reports.hourly_activity(inits))


# The samples show any rows; an order makes the choice comparable.
_SAMPLE_ORDER = {
    "bronze": ("kafka_offset",),
    "silver-init": ("time", "user-id"),
    "silver-match": ("time", "user-a"),
    "silver-purchase": ("time", "user-id"),
}


def _sample(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ordered = _layers(spark, sf_dir)[table].orderBy(*_SAMPLE_ORDER[table])
        return comparable(reports.sample(ordered, reports.SAMPLE_COLUMNS[table]))

    return run


for _table in _SAMPLE_ORDER:
    QUERIES[f"sample_{_table.removeprefix('silver-')}"] = _sample(_table)


# --- streams --------------------------------------------------------------------


def _lake(spark: SparkSession, **settings) -> Lake:
    return Lake(scratch_dir(spark, "lake"), **settings)


def _state_partitions(spark: SparkSession) -> int:
    """One state partition per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def _ingest(spark: SparkSession, sf_dir: str, **settings) -> Lake:
    lake = _lake(spark, **settings)
    await_all([run_bronze(kafka_rows(stream_events(spark, sf_dir)), lake, AVAILABLE_NOW)])
    return lake


def _silver_lake(spark: SparkSession, sf_dir: str, *tables: str, **settings) -> Lake:
    """Run bronze, then the silver job for the given tables."""
    lake = _ingest(spark, sf_dir, **settings)
    kinds = [default_event_types()[table] for table in tables]
    await_all(run_silver(spark, lake, AVAILABLE_NOW, kinds))
    return lake


@query("bronze_ingest")
def _(spark, sf_dir):
    return comparable(_ingest(spark, sf_dir).read(spark, "bronze").drop("event_date"))


def _silver_stream(spark, sf_dir, table: str) -> DataFrame:
    """A table with a query of its own, in one folder."""
    lake = _silver_lake(spark, sf_dir, table, by_day=False, shared_silver=False)
    return comparable(lake.read(spark, f"silver-{table}"))


for _table in ("init", "match", "purchase"):
    QUERIES[f"silver_{_table}_stream"] = partial(_silver_stream, table=_table)


@query("silver_fan_out_stream")
def _(spark, sf_dir):
    """All silver tables from one query; row counts by table."""
    lake = _silver_lake(spark, sf_dir, "init", "match", "purchase", files_per_batch=1)
    names = ("silver-init", "silver-match", "silver-purchase")
    return reports.row_counts({name: lake.read(spark, name) for name in names})


def _gold_stream(spark, sf_dir, name: str, tables: Sequence[str]) -> DataFrame:
    """Run all three layers as streams and read one gold table."""
    lake = _silver_lake(spark, sf_dir, *tables)
    parts = _state_partitions(spark)
    await_all(run_gold(spark, lake, AVAILABLE_NOW, state_partitions=parts, only=[name]))
    gold = read_table(spark, lake.table(f"gold-{name}"))
    revenue = [column for column in gold.columns if column.endswith("revenue")]
    return comparable(rounded(gold, *revenue))


for _name, _tables in {
    "minute-purchases": ("purchase",),
    "minute-matches": ("match",),
    "minute-revenue-by-product": ("purchase",),
    "minute-purchases-by-country": ("purchase", "init"),
    "minute-matches-by-country": ("match", "init"),
}.items():
    QUERIES[f"{_name.replace('-', '_')}_stream"] = partial(
        _gold_stream, name=_name, tables=_tables
    )

# Arrival times of the late-data query: the table's days in three parts. Purchases of
# products without a name arrive one part late.
LATE_BOUNDS = ("2024-01-11", "2024-01-21")


@query("late_data_stream")
def _(spark, sf_dir):
    """Minute purchases when some rows arrive after the watermark has passed them.

    One query, stopped and restarted from its checkpoint as each part arrives.
    """
    lake = _lake(spark)
    purchases = _silver(spark, sf_dir, "purchase").drop(*PROCESSING_TIME_COLUMNS)
    second, third = (F.lit(bound).cast("date") for bound in LATE_BOUNDS)
    part = F.when(event_date() < second, 0).when(event_date() < third, 1).otherwise(2)
    is_delayed = F.col("product_name") == "Unknown Product"
    delayed = F.least(part + F.when(is_delayed, 1).otherwise(0), F.lit(2))
    rows = purchases.withColumn("arrival", delayed)
    path, gold = lake.table("silver-purchase"), lake.table("gold-minute-purchases")
    for arrival in range(3):
        rows.filter(F.col("arrival") == arrival).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        with state_settings(spark, _state_partitions(spark)):
            run = append_stream(
                minute.minute_purchases(stream),
                gold,
                lake.checkpoint("gold-minute-purchases"),
                AVAILABLE_NOW,
            )
        await_all([run])
    return comparable(rounded(read_table(spark, gold), "total_revenue"))


@query("stream_progress")
def _(spark, sf_dir):
    """What the progress table holds of the minute-purchases query."""
    lake = _silver_lake(spark, sf_dir, "purchase")
    log = scratch_dir(spark, "progress")
    with logged_progress(spark, log):
        parts = _state_partitions(spark)
        [run] = run_gold(
            spark, lake, AVAILABLE_NOW, state_partitions=parts, only=["minute-purchases"]
        )
        await_all([run])
    mine = read_table(spark, log).filter(F.col("query_id") == str(run.id))
    return mine.agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows_dropped").alias("late_rows"),
        (F.count_distinct("batch_id") > 0).alias("has_batches"),
    )


@query("state_after_eviction")
def _(spark, sf_dir):
    """Init seconds that the purchases' join still keeps once it has seen everything."""
    lake = _silver_lake(spark, sf_dir, "purchase", "init")
    name = "minute-purchases-by-country"
    await_all(run_gold(spark, lake, AVAILABLE_NOW, state_partitions=_state_partitions(spark), only=[name]))
    kept = join_state(spark, lake.checkpoint(f"gold-{name}"))
    second = F.unix_seconds("_init_moment").alias("second")
    return kept.select(F.col("_init_user").alias("user"), "country_name", second, "copies")


def _fan_out(spark, sf_dir, table: str) -> DataFrame:
    lake = _silver_lake(spark, sf_dir, "init", "match", "purchase", files_per_batch=1)
    return comparable(lake.read(spark, f"silver-{table}").drop("event_date"))


for _table in ("init", "match", "purchase"):
    QUERIES[f"silver_fan_out_{_table}"] = partial(_fan_out, table=_table)


@query("compacted_days")
def _(spark, sf_dir):
    """Silver inits of which most days were compacted, one of them twice as rows came late."""
    lake = _lake(spark, files_per_batch=3)
    rows = kafka_rows(read_events(spark, sf_dir))
    late = (F.col("offset") % 5 == 0) & (F.col("timestamp") < F.lit(f"{DAY} 00:00:00").cast("timestamp"))
    days = rows.agg(F.min("timestamp").cast("date").cast("string")).first()[0], DAY
    for arrived in (~late, late):
        # Written as the bronze job would, so that each step is a micro-batch of the silver job.
        bronze.to_bronze(rows.filter(arrived)).write.mode("append").parquet(lake.table("bronze"))
        await_all(run_silver(spark, lake, AVAILABLE_NOW))
        lake.compact(spark, "silver-init", *days)
    return comparable(lake.read(spark, "silver-init").drop("event_date"))


@query("publish_valid_stream")
def _(spark, sf_dir):
    """Valid messages of a stream that holds broken ones, by topic; a table stands in for Kafka."""
    lake = _lake(spark)
    raw = bronze.to_bronze(kafka_rows(stream_events(spark, sf_dir), with_invalid=True))
    await_all([run_publish(raw, lake, AVAILABLE_NOW)])
    return read_table(spark, lake.table("published"))


@query("daily_job")
def _(spark, sf_dir):
    """The daily batch over a silver table laid out by day."""
    lake = _silver_lake(spark, sf_dir, "init", "match", "purchase")
    run_daily(spark, lake, *RANGE)
    return comparable(read_table(spark, lake.table("gold-daily-users")))


# Every user number below 20,000 has an entry: a dictionary far larger than the shipped ones.
_MANY_USERS = {f"user_{n:06d}": n * 7 for n in range(20_000)}


@query("rule_mapping_large")
def _(spark, sf_dir):
    params = {"source_field": "user-id", "mapping": _MANY_USERS}
    return _apply(spark, sf_dir, "init", {"field": "points", "type": "mapping", "params": params})
