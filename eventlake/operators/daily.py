"""Daily distinct users and their gold table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from eventlake.functions.event_time import between_days, event_date, iso_date, yesterday
from eventlake.sources.schema_log import log_schema
from eventlake.sources.tables import DEFAULT_FORMAT

Day = str | dt.date


def init_on_days(inits: DataFrame, first: Day | None = None, last: Day | None = None) -> DataFrame:
    """Inits with ``event_date`` in ``[first, last]``.

    ``last`` defaults to ``first``; without either, yesterday.
    """
    if first is None and last is not None:
        raise ValueError("a last day needs a first day")
    first_day = yesterday() if first is None else F.lit(iso_date(first)).cast("date")
    last_day = first_day if last is None else F.lit(iso_date(last)).cast("date")
    wanted = between_days(first_day, last_day)
    if "event_date" in inits.columns:
        # A table laid out by day: only these days' folders are listed.
        wanted = F.col("event_date").between(first_day, last_day) & wanted
    return inits.filter(wanted).withColumn("event_date", event_date())


def distinct_users(
    inits: DataFrame, by: Sequence[str] = ("country_name", "platform")
) -> DataFrame:
    """Exact distinct users per day and ``by``.

    Spark first drops repeated users within each task, so a user or group with a
    large share of the rows does not concentrate in one reducer.
    """
    if "event_date" not in inits.columns:
        inits = inits.withColumn("event_date", event_date())
    return (
        inits.groupBy("event_date", *by)
        .agg(F.count_distinct(F.col("`user-id`")).alias("distinct_users"))
        .withColumn("aggregation_timestamp", F.current_timestamp())
    )


def daily_users(inits: DataFrame, first: Day | None = None, last: Day | None = None) -> DataFrame:
    """The daily gold rows of one day (default yesterday) or an inclusive range."""
    return distinct_users(init_on_days(inits, first, last))


def daily_users_by_country(inits: DataFrame) -> DataFrame:
    """Counted from the events: users on two platforms must not count twice."""
    return distinct_users(inits, ("country_name",))


def write_daily(
    daily: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, overwrite: bool = False
) -> int:
    """Write daily rows partitioned by date in one action; returns the row count.

    Appending the same day again duplicates it. ``overwrite`` replaces the dates that
    occur in ``daily`` and leaves the others alone.
    """
    written = Observation()
    if fmt != "delta":
        log_schema(daily.sparkSession, path, daily.schema)
    writer = (
        daily.hint("rebalance", F.col("event_date"))
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format(fmt)
        .partitionBy("event_date")
    )
    if overwrite:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.save(path)
    return written.get["rows"]


def rows_per_date(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.col("event_date").desc())
    )


def users_ranked(daily: DataFrame, day: Day) -> DataFrame:
    """One gold day, largest groups first."""
    return daily.filter(F.col("event_date") == F.lit(iso_date(day)).cast("date")).orderBy(
        F.col("distinct_users").desc(), "country_name", "platform"
    )


def init_rows_per_date(inits: DataFrame, n: int = 10) -> DataFrame:
    """Init rows of the latest ``n`` dates."""
    return (
        inits.groupBy(event_date().alias("event_date"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.col("event_date").desc())
        .limit(n)
    )
