"""Windowed gold metrics. One definition serves batch and streams.

The watermark does nothing in batch. Distinct users are counted exactly: a first aggregate keeps one
row for each user of a window, a second one counts them. As a stream both are stateful and in
append mode; the state holds the users of the windows still open, and a window appears when the
watermark passes its end, no later than without the first aggregate. ``exact=False`` gives
estimates (HyperLogLog++) from a state of one row for each window.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventlake.functions.event_time import event_timestamp, window_bounds
from eventlake.operators.attribution import (
    LOOKBACK_SECONDS,
    WATERMARK_DELAY,
    init_multiplicity,
    stream_multiplicity,
)

WINDOW = "1 minute"


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _length(duration: str) -> int | None:
    """Seconds of a duration such as ``5 minutes``; None for other forms."""
    found = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", duration.strip())
    return int(found[1]) * _UNITS[found[2]] if found else None


def _in_panes(window: str, slide: str | None) -> bool:
    """Whether sliding windows are made of whole tumbling ones as long as the slide."""
    lengths = [_length(duration) for duration in (window, slide or window)]
    return bool(slide) and all(lengths) and lengths[0] % lengths[1] == 0


def _windowed(
    df: DataFrame,
    sums: dict[str, Column],
    users: dict[str, str],
    window: str,
    slide: str | None = None,
    key: str | None = None,
    exact: bool = True,
) -> DataFrame:
    """Sums, and distinct values of the ``users`` columns, by the window of ``event_timestamp`` and an optional key.

    Rows of a sliding window are added up by pane (and user) first, so that each pane, not each row, goes to
    all windows that it is part of. Estimates have nothing to add up by user and take the rows.
    """
    keys = [key] if key else []
    if exact and users:
        sides = [
            F.struct(F.lit(side).alias("side"), F.col(f"`{column}`").alias("user"))
            for side, column in enumerate(users.values())
        ]
        df = df.withColumn("_who", F.explode(F.array(*sides)) if len(sides) > 1 else sides[0])
        # A row counts towards the sums on its first side only.
        sums = {name: F.when(F.col("_who.side") == 0, value) for name, value in sums.items()}
    by = [*keys, "_who"] if exact and users else keys

    # An aggregate needs something to compute even where only users are asked for.
    totals = [F.sum(value).alias(name) for name, value in sums.items()] or [F.count("_who").alias("_rows")]
    again = [F.sum(name).alias(name) for name in sums]
    if _in_panes(window, slide) and (exact or not users):
        panes = df.groupBy(F.window("event_timestamp", slide), *by).agg(*totals)
        df, totals = panes.withColumn("event_timestamp", F.window_time("window")).drop("window"), again or totals
    span = F.window("event_timestamp", window, slide)
    if users and not exact:
        estimates = [F.approx_count_distinct(F.col(f"`{column}`")).alias(name) for name, column in users.items()]
        grouped = df.groupBy(span, *keys).agg(*totals, *estimates)
    elif users:
        known = F.col("_who.user").isNotNull()
        counts = [
            F.count_if(known & (F.col("_who.side") == side)).alias(name) for side, name in enumerate(users)
        ]
        grouped = df.groupBy(span, *by).agg(*totals).groupBy("window", *keys).agg(*again, *counts)
    else:
        grouped = df.groupBy(span, *keys).agg(*totals)
    return grouped.select(
        *window_bounds(),
        *keys,
        *sums,
        *users,
        F.current_timestamp().alias("aggregation_timestamp"),
    )


def with_event_time(df: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return df.withColumn("event_timestamp", event_timestamp()).withWatermark(
        "event_timestamp", delay
    )


def minute_purchases(
    purchases: DataFrame,
    window: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    exact: bool = True,
) -> DataFrame:
    sums = {"purchase_count": F.lit(1), "total_revenue": F.col("purchase_value")}
    users = {"distinct_users": "user-id"}
    return _windowed(with_event_time(purchases, delay), sums, users, window, exact=exact)


def minute_revenue_by_product(
    purchases: DataFrame, window: str = WINDOW, delay: str = WATERMARK_DELAY
) -> DataFrame:
    sums = {"purchase_count": F.lit(1), "product_revenue": F.col("purchase_value")}
    return _windowed(with_event_time(purchases, delay), sums, {}, window, key="product_name")


def minute_matches(
    matches: DataFrame,
    window: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    exact: bool = True,
) -> DataFrame:
    users = {"distinct_users_a": "user-a", "distinct_users_b": "user-b"}
    rows = with_event_time(matches, delay)
    return _windowed(rows, {"match_count": F.lit(1)}, users, window, exact=exact)


def _players(matches: DataFrame, sides: Sequence[str]) -> DataFrame:
    """One row per match and side, the player's id in ``player``."""
    return matches.withColumn("player", F.explode(F.array(*(F.col(f"`{s}`") for s in sides))))


def minute_match_players(
    matches: DataFrame,
    window: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    exact: bool = True,
) -> DataFrame:
    """Distinct players on either side; adding the two sides would count some twice."""
    players = with_event_time(_players(matches, ("user-a", "user-b")), delay)
    return _windowed(players, {}, {"distinct_users": "player"}, window, exact=exact)


def _attributed(
    events: DataFrame,
    inits: DataFrame,
    user: str,
    measures: dict[str, Column],
    lookback: int,
    delay: str,
) -> DataFrame:
    """(user, event_timestamp, country_name, copies, measures) per user and second."""
    if events.isStreaming:
        return stream_multiplicity(events, inits, user, measures, lookback, delay)
    seconds = init_multiplicity(events, inits, user, measures, lookback)
    return seconds.withColumn("event_timestamp", F.timestamp_seconds("second"))


def minute_purchases_by_country(
    purchases: DataFrame,
    inits: DataFrame,
    window: str = WINDOW,
    slide: str | None = None,
    lookback: int = LOOKBACK_SECONDS,
    delay: str = WATERMARK_DELAY,
    exact: bool = True,
) -> DataFrame:
    """Purchases and revenue per country of the buyer's inits in the look-back.

    A purchase counts once per matching init. As a stream, a window appears only
    after the look-back plus the delay has passed.
    """
    measures = {"_events": F.lit(1), "_revenue": F.col("purchase_value")}
    seconds = _attributed(purchases, inits, "user-id", measures, lookback, delay)
    sums = {
        "country_revenue": F.col("copies") * F.col("_revenue"),
        "purchase_count": F.col("copies") * F.col("_events"),
    }
    return _windowed(seconds, sums, {"distinct_users": "user"}, window, slide, "country_name", exact)


def minute_matches_by_country(
    matches: DataFrame,
    inits: DataFrame,
    window: str = WINDOW,
    sides: Sequence[str] = ("user-a",),
    lookback: int = LOOKBACK_SECONDS,
    delay: str = WATERMARK_DELAY,
    exact: bool = True,
) -> DataFrame:
    """Matches per country of player A's inits, or of both players' with two sides."""
    players = _players(matches, sides)
    seconds = _attributed(players, inits, "player", {"_events": F.lit(1)}, lookback, delay)
    sums = {"match_count": F.col("copies") * F.col("_events")}
    return _windowed(seconds, sums, {"distinct_users": "user"}, window, key="country_name", exact=exact)


def minute_rows_since(gold: DataFrame, since: str, n: int = 10) -> DataFrame:
    """The latest ``n`` windows that start at or after ``since``."""
    return (
        gold.filter(F.col("window_start") >= F.lit(since).cast("timestamp"))
        .orderBy(F.col("window_start").desc())
        .limit(n)
    )
