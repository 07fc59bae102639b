"""The bronze, silver and gold streaming jobs over one lake folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.functions.event_time import event_timestamp
from eventlake.operators.attribution import WATERMARK_DELAY
from eventlake.operators.bronze import to_bronze
from eventlake.operators.daily import Day, daily_users, write_daily
from eventlake.operators.minute import (
    WINDOW,
    minute_matches,
    minute_matches_by_country,
    minute_purchases,
    minute_purchases_by_country,
    minute_revenue_by_product,
)
from eventlake.operators.silver import TABLE, to_shared_silver, to_shared_values, to_silver
from eventlake.operators.validity import observe_validity, route_topics, validate_events
from eventlake.plans.event_types import EventType, default_event_types
from eventlake.schemas import BRONZE_DDL
from eventlake.sources.kafka import kafka_sink_options
from eventlake.sources.schema_log import logged_schema
from eventlake.sources.tables import DEFAULT_FORMAT, read_table_stream
from eventlake.streaming.compaction import compact_days, read_compacted
from eventlake.streaming.sinks import (
    append_stream,
    publish_stream,
    state_settings,
    triggered,
)
from eventlake.streaming.supervise import start_all


@dataclass(frozen=True)
class Lake:
    """Where tables and checkpoints live; executors must share ``root``.

    ``by_day`` lays bronze and silver tables out in one folder per day of the message or
    event, in a further column ``event_date``; late events go to their own day.
    ``files_per_batch`` bounds the files that a micro-batch adds to each folder; without folders by day, large files
    become several. ``shared_silver`` keeps all silver rows
    in one table with a folder for each event type, written by one query that parses bronze once;
    without it there are a query and a table for each type.
    """

    root: str
    fmt: str = DEFAULT_FORMAT
    by_day: bool = True
    files_per_batch: int | None = 4
    shared_silver: bool = True

    def table(self, name: str) -> str:
        layer, _, table = name.partition("-")
        return f"{self.root}/{layer}/{table.replace('-', '_') or 'events'}"

    def _shared(self, name: str) -> bool:
        return self.shared_silver and name.startswith("silver-")

    def _holder(self, name: str) -> str:
        """The folder with a table's rows."""
        return self.table("silver" if self._shared(name) else name)

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name.replace('-', '_')}"

    def _of(self, df: DataFrame, name: str, columns: Sequence[str] | None) -> DataFrame:
        if self._shared(name):
            df = df.filter(F.col(TABLE) == name.removeprefix("silver-")).drop(TABLE)
            if columns:
                df = df.select(*(F.col(f"`{c}`") for c in df.columns if c in {*columns, "event_date"}))
        return df

    def read(self, spark: SparkSession, name: str, event_types: Sequence[EventType] | None = None) -> DataFrame:
        """A table, a silver one with the columns of its type; days and types not asked for are never read."""
        df = read_compacted(spark, self._holder(name), self.fmt)
        return self._of(df, name, _columns(spark, name, event_types))

    def compact(self, spark: SparkSession, name: str, first: Day, last: Day | None = None) -> int:
        """Rewrite the small files of some days of a bronze or silver table; returns how many."""
        if not self.by_day:
            raise ValueError("only tables laid out by day are compacted")
        return compact_days(spark, self._holder(name), first, last, self.fmt)

    def read_stream(
        self,
        spark: SparkSession,
        name: str,
        max_files_per_trigger: int | None = None,
        event_types: Sequence[EventType] | None = None,
    ) -> DataFrame:
        """A table as a stream; bronze and silver tables need not have rows yet, only exist."""
        kinds = {t.silver_table: t for t in event_types or default_event_types().values()}
        layer, _, table = name.partition("-")
        schema = BRONZE_DDL if layer == "bronze" else None
        if schema is None and table not in kinds and self.fmt != "delta":
            schema = logged_schema(spark, self._holder(name))
        if layer == "silver" and table in kinds:
            schema = silver_schema(spark, kinds[table])
            if self.shared_silver:
                schema = StructType([*schema.fields, StructField(TABLE, StringType())])
        stream = read_table_stream(spark, self._holder(name), schema, self.fmt, max_files_per_trigger)
        return self._of(stream, name, None)

    def append(self, df: DataFrame, name: str, trigger: str) -> StreamingQuery:
        folders: tuple[str, ...] = (TABLE,) if TABLE in df.columns else ()
        if self.by_day and not name.startswith("gold"):
            time = "kafka_timestamp" if name == "bronze" else event_timestamp()
            df, folders = df.withColumn("event_date", F.to_date(time)), (*folders, "event_date")
        return append_stream(
            df,
            self.table(name),
            self.checkpoint(name),
            trigger,
            self.fmt,
            partition_by=folders,
            files_per_batch=self.files_per_batch,
        )


def _columns(spark: SparkSession, name: str, event_types: Sequence[EventType] | None) -> list[str] | None:
    """Columns of a silver table by its event type; None for other tables and types not known."""
    kinds = {f"silver-{t.silver_table}": t for t in event_types or default_event_types().values()}
    return silver_schema(spark, kinds[name]).names if name in kinds else None


@dataclass(frozen=True)
class KafkaTarget:
    servers: str
    topic: str


def run_bronze(
    kafka: DataFrame,
    lake: Lake,
    trigger: str = "10 seconds",
    transform: Callable[[DataFrame], DataFrame] = to_bronze,
) -> StreamingQuery:
    """One ingest query for all topics: a single writer never conflicts with itself."""
    return lake.append(transform(kafka), "bronze", trigger)


def run_publish(
    bronze: DataFrame,
    lake: Lake,
    trigger: str = "10 seconds",
    servers: str | None = None,
    topic: str | None = None,
) -> StreamingQuery:
    """The entry gate: validate raw payloads, route the valid ones to topics and publish them.

    With ``servers`` they go to Kafka, else to the table ``published``. Each micro-batch's
    counters are in the query progress as ``validity``: all, valid, invalid and untimed rows.
    """
    checked = observe_validity(validate_events(bronze), "validity")
    routed = route_topics(checked.filter("is_valid"), topic=topic)
    if not servers:
        return append_stream(
            routed, lake.table("published"), lake.checkpoint("published"), trigger, lake.fmt
        )
    options = kafka_sink_options(servers, None, lake.checkpoint("published"))
    writer = routed.writeStream.format("kafka").outputMode("append").options(**options)
    return triggered(writer, trigger).start()


def run_daily(
    spark: SparkSession,
    lake: Lake,
    first: Day | None = None,
    last: Day | None = None,
    overwrite: bool = True,
) -> int:
    """The daily batch: inits of one day (default yesterday) or a range to gold rows; returns their number."""
    inits = lake.read(spark, "silver-init")
    daily = daily_users(inits, first, last)
    return write_daily(daily, lake.table("gold-daily-users"), lake.fmt, overwrite)


def _counters(silver: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Counts each table's rows, and those whose time no window or day can hold, as ``silver`` of the progress."""
    counts = []
    for table in tables:
        mine = F.col(TABLE) == table if TABLE in silver.columns else F.lit(True)
        prefix = f"{table}_" if TABLE in silver.columns else ""
        counts.append(F.count_if(mine).alias(f"{prefix}rows"))
        counts.append(F.count_if(mine & event_timestamp().isNull()).alias(f"{prefix}untimed"))
    return silver.observe("silver", *counts)


def run_silver(
    spark: SparkSession,
    lake: Lake,
    trigger: str = "10 seconds",
    event_types: Sequence[EventType] | None = None,
    kafka: KafkaTarget | None = None,
    max_files_per_trigger: int | None = None,
) -> list[StreamingQuery]:
    """All silver tables from one query that parses each bronze row once, and one more for Kafka.

    A micro-batch is one write, by type and day, that Spark's file sink (or the table format) commits as a whole. In a
    lake without a shared silver table there is a query per event type and sink.

    The progress counts each table's rows, and those whose time no window or day can hold, as
    ``silver``: ``init_rows``, ``init_untimed`` and so on, without a prefix where each table has its query.
    """
    kinds = list(event_types or default_event_types().values())
    bronze = lake.read_stream(spark, "bronze", max_files_per_trigger)
    starters: list[Callable[[], StreamingQuery | None]] = []

    def add(name: str, rows: DataFrame, values: DataFrame, tables: Sequence[str]) -> None:
        starters.append(partial(lake.append, _counters(rows, tables), name, trigger))
        if kafka:
            target = (kafka.servers, kafka.topic, lake.checkpoint(name))
            starters.append(partial(publish_stream, values, *target, trigger))

    if lake.shared_silver:
        values = to_shared_values(bronze, kinds)
        add("silver", to_shared_silver(bronze, kinds), values, [t.silver_table for t in kinds])
    else:
        for event_type in kinds:
            rows = to_silver(bronze, event_type)
            add(f"silver-{event_type.silver_table}", rows, rows, [event_type.silver_table])
    return start_all(starters)


def silver_schema(spark: SparkSession, event_type: EventType):
    """Schema of a silver table before its first row exists."""
    return to_silver(spark.createDataFrame([], BRONZE_DDL), event_type).schema


def run_gold(
    spark: SparkSession,
    lake: Lake,
    trigger: str = "1 minute",
    window: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    state_partitions: int | None = None,
    max_files_per_trigger: int | None = None,
    only: Sequence[str] | None = None,
) -> list[StreamingQuery]:
    """The windowed gold tables, one query each.

    ``only`` picks tables by name; the default is the four standard ones.
    ``minute-revenue-by-product`` is available on request.
    """
    def silver(table: str) -> DataFrame:
        return lake.read_stream(spark, f"silver-{table}", max_files_per_trigger)

    def by_country(function: Callable[..., DataFrame], table: str) -> DataFrame:
        return function(silver(table), silver("init"), window=window, delay=delay)

    tables: dict[str, Callable[[], DataFrame]] = {
        "minute-purchases": lambda: minute_purchases(silver("purchase"), window, delay),
        "minute-matches": lambda: minute_matches(silver("match"), window, delay),
        "minute-purchases-by-country": lambda: by_country(
            minute_purchases_by_country, "purchase"
        ),
        "minute-matches-by-country": lambda: by_country(minute_matches_by_country, "match"),
    }
    optional = {
        "minute-revenue-by-product": lambda: minute_revenue_by_product(
            silver("purchase"), window, delay
        ),
    }
    names = only or list(tables)
    with state_settings(spark, state_partitions):
        return start_all(
            [
                partial(lake.append, (tables | optional)[name](), f"gold-{name}", trigger)
                for name in names
            ]
        )
