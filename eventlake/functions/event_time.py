"""Event time: epoch milliseconds to timestamps, dates and pushable ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Timestamps outside years 0001-9999 become null instead of failing the job.
_MIN_SECOND = -62135596800
_MAX_SECOND = 253402300799


def event_second(ms: str = "time") -> Column:
    """Whole epoch seconds, truncated toward zero."""
    return F.call_function("div", F.col(ms), F.lit(1000))


def event_timestamp(ms: str = "time") -> Column:
    """Event timestamp with second precision, free of any time-zone round trip."""
    second = event_second(ms)
    return F.timestamp_seconds(F.when(second.between(_MIN_SECOND, _MAX_SECOND), second))


def event_date(ms: str = "time") -> Column:
    """Calendar date of the event in the session time zone."""
    return F.to_date(event_timestamp(ms))


def iso_date(value: str | dt.date) -> str:
    """Check a ``YYYY-MM-DD`` argument; ANSI mode would fail on it much later."""
    if isinstance(value, dt.datetime):
        raise ValueError(f"expected a date, got a datetime: {value!r}")
    if isinstance(value, dt.date):
        return value.isoformat()
    try:
        return dt.datetime.strptime(value, "%Y-%m-%d").date().isoformat()
    except (TypeError, ValueError) as error:
        raise ValueError(f"expected YYYY-MM-DD, got {value!r}") from error


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)


def between_days(first: Column, last: Column, ms: str = "time") -> Column:
    """Rows whose event date lies in ``[first, last]``.

    The date predicate alone hides the raw column from the file scan. The extra
    range on the raw milliseconds folds to constants, reaches Parquet and skips
    row groups and files. It starts a second early because seconds are truncated
    toward zero; the date predicate keeps the result exact.
    """
    low = F.unix_millis(first.cast("timestamp")) - 1000
    high = F.unix_millis(F.date_add(last, 1).cast("timestamp"))
    return (
        (F.col(ms) > low)
        & (F.col(ms) < high)
        & event_date(ms).between(first, last)
    )


def window_bounds(window: str = "window") -> list[Column]:
    return [
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
    ]
