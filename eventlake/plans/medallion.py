"""All nine lake tables as lazy batch DataFrames over one set of Kafka rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.operators.bronze import to_bronze
from eventlake.operators.daily import distinct_users
from eventlake.operators.minute import (
    WINDOW,
    minute_matches,
    minute_matches_by_country,
    minute_purchases,
    minute_purchases_by_country,
)
from eventlake.operators.silver import TABLE, clean, parse_events, to_shared_silver
from eventlake.plans.event_types import default_event_types
from eventlake.sources.tables import read_table


def silver_tables(bronze: DataFrame) -> dict[str, DataFrame]:
    """Silver DataFrames by table name, all over the same parsed rows."""
    parsed = parse_events(bronze)
    return {name: clean(parsed, kind) for name, kind in default_event_types().items()}


def gold_tables(
    silver: dict[str, DataFrame], window: str = WINDOW, exact: bool = True
) -> dict[str, DataFrame]:
    init, match, purchase = silver["init"], silver["match"], silver["purchase"]
    return {
        "gold-daily-users": distinct_users(init),
        "gold-minute-purchases": minute_purchases(purchase, window, exact=exact),
        "gold-minute-matches": minute_matches(match, window, exact=exact),
        "gold-minute-purchases-by-country": minute_purchases_by_country(
            purchase, init, window, exact=exact
        ),
        "gold-minute-matches-by-country": minute_matches_by_country(
            match, init, window, exact=exact
        ),
    }


def layers(kafka: DataFrame, window: str = WINDOW, exact: bool = True) -> dict[str, DataFrame]:
    bronze = to_bronze(kafka)
    silver = silver_tables(bronze)
    named = {f"silver-{name}": df for name, df in silver.items()}
    return {"bronze": bronze} | named | gold_tables(silver, window, exact)


def written_layers(
    spark: SparkSession, kafka: DataFrame, root: str, window: str = WINDOW
) -> dict[str, DataFrame]:
    """The same tables, each computed once from the written one before and read back.

    Silver is one write by type; the gold tables are independent jobs that share the cluster.
    """

    def written(name: str, df: DataFrame, *folders: str) -> DataFrame:
        df.write.partitionBy(*folders).parquet(f"{root}/{name}")
        return read_table(spark, f"{root}/{name}")

    bronze = written("bronze", to_bronze(kafka))
    kinds = default_event_types()
    rows = written("silver", to_shared_silver(bronze, list(kinds.values())), TABLE)
    silver = {name: rows.filter(F.col(TABLE) == name).drop(TABLE) for name in kinds}
    tables = gold_tables(silver, window)
    with ThreadPoolExecutor(len(tables)) as jobs:
        gold = dict(zip(tables, jobs.map(written, tables, tables.values())))
    return {"bronze": bronze} | {f"silver-{name}": df for name, df in silver.items()} | gold
