"""Reports over the nine lake tables, as DataFrames."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.sources.schema_log import read_logged
from eventlake.sources.tables import DEFAULT_FORMAT, try_read

log = logging.getLogger(__name__)

# How many rows samples, rankings and window reports show.
SAMPLE_ROWS = 10
TOP_ROWS = 10
WINDOW_ROWS = 20


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(*columns)


def top_by_count(df: DataFrame, column: str, n: int = TOP_ROWS) -> DataFrame:
    counted = df.groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.col("count").desc(), F.col(f"`{column}`")).limit(n)


def total_revenue(purchases: DataFrame) -> DataFrame:
    return purchases.agg(F.coalesce(F.sum("purchase_value"), F.lit(0.0)).alias("total_revenue"))


def revenue_by_product(purchases: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return (
        purchases.groupBy("product_name")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("purchase_value").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "product_name")
        .limit(n)
    )


def top_countries_by_revenue(gold: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return (
        gold.groupBy("country_name")
        .agg(
            F.sum("country_revenue").alias("total_revenue"),
            F.sum("purchase_count").alias("total_purchases"),
        )
        .orderBy(F.col("total_revenue").desc(), "country_name")
        .limit(n)
    )


def top_countries_by_matches(gold: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return (
        gold.groupBy("country_name")
        .agg(F.sum("match_count").alias("total_matches"))
        .orderBy(F.col("total_matches").desc(), "country_name")
        .limit(n)
    )


def first_rows(df: DataFrame, *order: str, n: int = WINDOW_ROWS) -> DataFrame:
    """The first ``n`` rows in ascending order: for windows, the oldest ones."""
    return df.orderBy(*order).limit(n)


def hourly_activity(df: DataFrame, timestamp: str = "event_timestamp") -> DataFrame:
    return (
        df.groupBy(F.window(timestamp, "1 hour"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "count",
        )
        .orderBy("window_start")
    )


def sample(df: DataFrame, columns: Iterable[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """Any ``n`` rows of the display columns; order the input first for a fixed choice."""
    return df.select(*(F.col(f"`{name}`") for name in columns)).limit(n)


# Columns shown in table samples.
SAMPLE_COLUMNS = {
    "bronze": ("kafka_topic", "kafka_timestamp", "ingestion_timestamp"),
    "silver-init": ("user-id", "platform", "country", "country_name", "processing_timestamp"),
    "silver-match": (
        "user-a",
        "user-b",
        "winner",
        "user_a_platform",
        "user_b_platform",
        "game-tier",
    ),
    "silver-purchase": (
        "user-id",
        "product-id",
        "product_name",
        "purchase_value",
        "processing_timestamp",
    ),
}

Report = Callable[[DataFrame], DataFrame]


def _sample_of(table: str) -> Report:
    return lambda df: sample(df, SAMPLE_COLUMNS[table])


REPORTS: dict[str, dict[str, Report]] = {
    "bronze": {
        "events by topic": lambda df: count_by(df, "kafka_topic"),
        "sample": _sample_of("bronze"),
    },
    "silver-init": {
        "events by platform": lambda df: count_by(df, "platform"),
        "events by country": lambda df: top_by_count(df, "country_name"),
        "sample": _sample_of("silver-init"),
    },
    "silver-match": {
        "player A platforms": lambda df: count_by(df, "user_a_platform"),
        "sample": _sample_of("silver-match"),
    },
    "silver-purchase": {
        "total revenue": total_revenue,
        "revenue by product": revenue_by_product,
        "sample": _sample_of("silver-purchase"),
    },
    "gold-daily-users": {
        "daily users": lambda df: first_rows(df, "event_date", "country_name", "platform"),
    },
    "gold-minute-purchases": {"windows": lambda df: first_rows(df, "window_start")},
    "gold-minute-matches": {"windows": lambda df: first_rows(df, "window_start")},
    "gold-minute-purchases-by-country": {
        "top countries by revenue": top_countries_by_revenue,
        "windows": lambda df: first_rows(df, "window_start", "country_name"),
    },
    "gold-minute-matches-by-country": {
        "top countries by matches": top_countries_by_matches,
        "windows": lambda df: first_rows(df, "window_start", "country_name"),
    },
}


def select_tables(tables: Iterable[str] | None = None) -> list[str]:
    """Requested table names in the order given; all nine by default."""
    names = list(tables or REPORTS)
    unknown = [name for name in names if name not in REPORTS]
    if unknown:
        raise ValueError(f"unknown tables {unknown}, available: {list(REPORTS)}")
    return names


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table as ``table, rows``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_reports(name: str, df: DataFrame) -> dict[str, DataFrame]:
    counted = {"total records": row_counts({name: df}).select("rows")}
    return counted | {title: report(df) for title, report in REPORTS[name].items()}


def report(
    spark: SparkSession,
    paths: Mapping[str, str],
    tables: Iterable[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, dict[str, DataFrame]]:
    """Report DataFrames per table; missing or unreadable tables are skipped."""
    return report_on(lambda name: read_logged(spark, paths[name], fmt), tables)


def report_on(
    read: Callable[[str], DataFrame], tables: Iterable[str] | None = None
) -> dict[str, dict[str, DataFrame]]:
    """The same over tables that ``read`` gives by name."""
    found = {}
    for name in select_tables(tables):
        df = try_read(lambda: read(name), name)
        if df is not None:
            found[name] = table_reports(name, df)
    return found


def show(reports: Mapping[str, Mapping[str, DataFrame]], n: int = WINDOW_ROWS) -> None:
    """Print reports without truncation; a table that fails does not stop the others."""
    for table, entries in reports.items():
        try:
            for title, df in entries.items():
                print(f"\n{table}: {title}")
                df.show(n, truncate=False)
        except Exception as error:  # any read error: report it, go on with the next table
            log.warning("cannot report on %s: %s", table, error)
