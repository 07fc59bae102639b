"""Attach to each event the countries its user opened the game from in the last 24 h.

The relation is a left outer interval join: same user, and the init at most 24 hours
before the event (both ends inclusive, whole seconds). An event with k such inits
counts k times; without any it counts once under a null country.

All inits of one user and country within a second are interchangeable, and so are a
user's events of a second for the windowed metrics. Streams add both sides up per second
before they join them, so pairs are of seconds, not of rows. Batch jobs form no
pairs: they sweep a running count of *active* inits along each user's time line instead:

* time is cut into buckets as long as the look-back. An init is active from its own
  second to the end of its bucket, and in the next bucket from the start to the same
  offset; three signed steps describe that.
* events and steps are added up per (user, bucket, offset, country) before the
  shuffle. One (user, bucket) group then holds at most one row per second and
  country, however many raw rows the user has.
* a running sum inside each group turns steps into the number of matching inits.

The work is linear in the input and no task ever holds the raw rows of a hot user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.functions.event_time import event_second, event_timestamp

LOOKBACK_SECONDS = 24 * 60 * 60
WATERMARK_DELAY = "10 minutes"


def _bucketed(df: DataFrame, user: str, lookback: int) -> DataFrame:
    """Adds ``_user``, ``_bucket`` and ``_offset`` for the whole-second event time."""
    second = F.unix_seconds(event_timestamp())
    return df.withColumns(
        {
            "_user": F.col(f"`{user}`"),
            "_bucket": F.floor(second / lookback),
            "_offset": F.pmod(second, F.lit(lookback)),
        }
    )


def _steps(inits: DataFrame, lookback: int) -> DataFrame:
    """Signed changes of the number of active inits."""
    located = _bucketed(inits, "user-id", lookback).filter(
        "_user is not null and _bucket is not null"
    )

    def step(bucket: Column, offset: Column, change: int) -> Column:
        return F.struct(
            bucket.alias("_bucket"),
            offset.cast("bigint").alias("_offset"),
            F.lit(change).cast("bigint").alias("_step"),
        )

    bucket, offset = F.col("_bucket"), F.col("_offset")
    return located.select(
        "_user",
        "country_name",
        F.inline(
            F.array(
                step(bucket, offset, 1),
                step(bucket + 1, F.lit(-1), 1),
                step(bucket + 1, offset + 1, -1),
            )
        ),
    )


def init_multiplicity(
    events: DataFrame,
    inits: DataFrame,
    user: str = "user-id",
    measures: dict[str, Column] | None = None,
    lookback: int = LOOKBACK_SECONDS,
) -> DataFrame:
    """Countries in reach of each (user, second) that has events, with multiplicity.

    Returns ``user, second, country_name, copies`` and the ``measures``, which are
    sums over the events of that user and second. A (user, second) without inits in
    reach has one row with null country and ``copies`` 1.
    """
    measures = measures or {}
    points = _bucketed(events, user, lookback).select(
        "_user",
        "_bucket",
        "_offset",
        F.lit(None).cast("string").alias("country_name"),
        F.lit(0).cast("bigint").alias("_step"),
        F.lit(True).alias("_is_event"),
        *(expression.alias(name) for name, expression in measures.items()),
    )
    steps = _steps(inits, lookback).withColumn("_is_event", F.lit(False))
    rows = (
        points.unionByName(steps, allowMissingColumns=True)
        .groupBy("_user", "_bucket", "_offset", "country_name", "_is_event")
        .agg(F.sum("_step").alias("_step"), *(F.sum(name).alias(name) for name in measures))
    )

    is_event = F.col("_is_event")
    country = F.struct("country_name")
    timeline = Window.partitionBy("_user", "_bucket")
    so_far = timeline.orderBy("_offset").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    per_country = (
        Window.partitionBy("_user", "_bucket", "country_name")
        .orderBy("_offset")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # An event row is repeated for every country of its group, a step keeps its own.
    targets = (
        F.when(~is_event, F.array(country))
        .when(F.col("_reach") == 0, F.array(country))
        .otherwise(F.col("_countries"))
    )
    return (
        rows.withColumn("_reach", F.sum("_step").over(so_far))
        .withColumn("_countries", F.collect_set(F.when(~is_event, country)).over(timeline))
        .withColumn("_target", F.explode(targets))
        .withColumn("country_name", F.col("_target.country_name"))
        .withColumn("_active", F.sum("_step").over(per_country))
        .filter(is_event)
        .select(
            F.col("_user").alias("user"),
            (F.col("_bucket") * lookback + F.col("_offset")).alias("second"),
            "country_name",
            F.when(F.col("_reach") == 0, F.lit(1)).otherwise(F.col("_active")).alias("copies"),
            *measures,
        )
        .filter("copies > 0")
    )


def enrich(
    events: DataFrame,
    inits: DataFrame,
    user: str = "user-id",
    lookback: int = LOOKBACK_SECONDS,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Events with ``event_timestamp``, ``country_name`` and ``copies``.

    In batch there is one row per event and country in reach, ``copies`` being the number of
    matching inits, 1 without any. As a stream there is one row per event, country and second
    with inits, whose ``copies`` add up to the same.
    """
    if events.isStreaming or inits.isStreaming:
        left = events.withColumn("event_timestamp", event_timestamp())
        # As late within the second as the times of added-up inits.
        moment = F.col("event_timestamp") + F.expr("interval 999999 microseconds")
        left = left.withColumn("_moment", moment).withWatermark("_moment", delay)
        return _joined(left, inits, user, lookback, delay).drop("_moment")
    seconds = init_multiplicity(events, inits, user, lookback=lookback)
    return _attach(events, seconds, user).withColumn("copies", F.coalesce("copies", F.lit(1)))


def enrich_latest(
    events: DataFrame,
    inits: DataFrame,
    user: str = "user-id",
    lookback: int = LOOKBACK_SECONDS,
) -> DataFrame:
    """As-of variant, batch only: one row per event with its most recent init's country.

    Inits with the same millisecond are ordered by country name.
    """
    located = _bucketed(inits, "user-id", lookback).filter(
        "_user is not null and _bucket is not null"
    )
    # The next bucket only needs the last inits of this one, placed before its start.
    candidates = located.select(
        "_user",
        "country_name",
        "time",
        F.inline(
            F.array(
                F.struct("_bucket", "_offset"),
                F.struct(
                    (F.col("_bucket") + 1).alias("_bucket"),
                    F.lit(-1).cast("bigint").alias("_offset"),
                ),
            )
        ),
    ).withColumn("_is_event", F.lit(False))
    points = _bucketed(events, user, lookback).select(
        "_user", "_bucket", "_offset", F.lit(True).alias("_is_event")
    )
    so_far = (
        Window.partitionBy("_user", "_bucket")
        .orderBy("_offset")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    init = F.when(~F.col("_is_event"), F.struct("time", "country_name"))
    second = F.col("_bucket") * lookback + F.col("_offset")
    seconds = (
        points.unionByName(candidates, allowMissingColumns=True)
        .groupBy("_user", "_bucket", "_offset", "_is_event", "country_name")
        .agg(F.max("time").alias("time"))
        .withColumn("_init", F.max(init).over(so_far))
        .filter(F.col("_is_event") & (event_second("_init.time") >= second - lookback))
        .select(
            F.col("_user").alias("user"),
            second.alias("second"),
            F.col("_init.country_name").alias("country_name"),
        )
    )
    return _attach(events, seconds, user)


def _attach(events: DataFrame, seconds: DataFrame, user: str) -> DataFrame:
    """Left join per-(user, second) facts back to the event rows.

    Events without a user match nothing; a hash of the row stands in for their join
    key, so that they do not all meet in one task.
    """
    name = F.col(f"`{user}`")
    stand_in = F.xxhash64(*(F.col(f"`{column}`") for column in events.columns))
    return (
        events.withColumn("event_timestamp", event_timestamp())
        .withColumn("_key", F.coalesce(name, stand_in.cast("string")))
        .withColumn("_second", F.unix_seconds("event_timestamp"))
        .join(
            seconds.withColumnsRenamed({"user": "_seen_user", "second": "_seen_second"}),
            (F.col("_key") == F.col("_seen_user"))
            & (F.col("_second") == F.col("_seen_second"))
            & name.isNotNull(),
            "left",
        )
        .drop("_key", "_second", "_seen_user", "_seen_second")
    )


def _seconds(df: DataFrame, keys: Sequence[Column], delay: str, *sums: Column) -> DataFrame:
    """Rows of a stream added up by key and second; ``_moment`` is the second's last microsecond."""
    return (
        df.withColumn("_at", event_timestamp())
        .withWatermark("_at", delay)
        .groupBy(F.window("_at", "1 second"), *keys)
        .agg(*sums)
        .withColumn("_moment", F.window_time("window"))
        .drop("window")
    )


def _span(moment: Column, lookback: int) -> Column:
    """Number of the span of time, twice as long as the look-back, that a moment lies in."""
    return F.floor(F.unix_seconds(moment) / max(2 * lookback, 1))


def _joined(
    left: DataFrame, inits: DataFrame, user: str, lookback: int, delay: str
) -> DataFrame:
    """Stream-stream left outer interval join of ``left`` by ``_moment`` with the inits' seconds.

    Both sides carry a watermark, so the state store drops inits once nothing can reach
    them and emits what stayed unmatched. A user's state has at most one row per second and
    country, however many inits there were, and one more if the init reaches into the next span of time. Rows meet
    within a user's span only: however many days a micro-batch brings, an event is compared with the inits of three days
    at most (of one span and a look-back), not with all of its user's. Rows without a user can match nothing: a hash stands in for their join
    key, so they are dealt over all tasks, and the condition refuses them before
    the join, so they pass at once without ever being kept.
    """
    keys = [F.col("`user-id`").alias("_init_user"), F.col("country_name")]
    known = inits.filter(F.col("`user-id`").isNotNull())
    right = _seconds(known, keys, delay, F.count(F.lit(1)).alias("copies"))
    right = right.withColumnRenamed("_moment", "_init_moment")
    moment, reach = F.col("_init_moment"), F.expr(f"interval {lookback} seconds")
    spans = F.sequence(_span(moment, lookback), _span(moment + reach, lookback))
    right = right.withColumn("_init_span", F.explode(spans))
    name = F.col(f"`{user}`")
    stand_in = F.xxhash64(*(F.col(f"`{column}`") for column in left.columns))
    left = left.withColumn("_key", F.coalesce(name, stand_in.cast("string")))
    left = left.withColumn("_span", _span(F.col("_moment"), lookback))
    condition = (
        (F.col("_key") == F.col("_init_user"))
        & (F.col("_span") == F.col("_init_span"))
        & name.isNotNull()
        & (moment <= F.col("_moment"))
        & (moment >= F.col("_moment") - reach)
    )
    joined = left.join(right, condition, "left").drop("_init_user", "_init_moment", "_init_span", "_key", "_span")
    return joined.withColumn("copies", F.coalesce("copies", F.lit(1)))


def stream_multiplicity(
    events: DataFrame,
    inits: DataFrame,
    user: str = "user-id",
    measures: dict[str, Column] | None = None,
    lookback: int = LOOKBACK_SECONDS,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """The stream's form of :func:`init_multiplicity`, with ``event_timestamp`` for windows.

    Where a row is kept depends on its own key and time alone, so a restart finds all of
    the state that earlier runs left.
    """
    sums = [F.sum(expression).alias(name) for name, expression in (measures or {}).items()]
    left = _seconds(events, [F.col(f"`{user}`").alias("user")], delay, *sums)
    return _joined(left, inits, "user", lookback, delay).withColumnRenamed(
        "_moment", "event_timestamp"
    )
