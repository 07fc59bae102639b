"""Daily users as bitmaps that can be united, so countries, platforms and ranges of days need no second scan.

Distinct users cannot be added up: one that played on two platforms or days would count twice. Here every user has
a number, kept in a dictionary table that only ever grows, and a rollup row holds the users of one day, country,
platform and block of numbers as bits. Any coarser question unites bitmaps and counts them; the answers are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventlake.functions.event_time import event_date, iso_date
from eventlake.operators.daily import Day
from eventlake.sources.tables import DEFAULT_FORMAT, read_table, try_read_table

#: New users are numbered in so many independent parts.
PARTS = 256
GROUPS = ("event_date", "country_name", "platform")
DICTIONARY_DDL = "user string, number bigint"


def _between(first: Day | None, last: Day | None) -> Column:
    """Days of a table that has ``event_date``."""
    day, wanted = F.col("event_date"), F.lit(True)
    if first is not None:
        wanted &= day >= F.lit(iso_date(first)).cast("date")
    if last is not None:
        wanted &= day <= F.lit(iso_date(last)).cast("date")
    return wanted


def add_users(spark: SparkSession, inits: DataFrame, dictionary: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Give users that the dictionary table lacks the numbers that follow its last; returns the table.

    Numbers are dense, from 1, and never change. Users are numbered within parts by hash, and the parts follow each other, so no
    task sees all users; what is put in one row after the other is the sizes of the ``PARTS``. One job at a time
    may add users. A repeated run finds its users there.
    """
    users = inits.select(F.col("`user-id`").alias("user")).filter("user is not null").distinct()
    known = try_read_table(spark, dictionary, fmt)
    next_number = 1
    if known is not None:
        users = users.join(known.select("user"), "user", "left_anti")
        next_number = known.agg(F.coalesce(F.max("number") + 1, F.lit(1))).first()[0]
    parted = users.withColumn("part", F.pmod(F.xxhash64("user"), F.lit(PARTS)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("user"))
    # At most one row for each part.
    numbered = parted.withColumn("place", place).join(F.broadcast(starts), "part")
    number = F.lit(next_number) + F.col("start") + F.col("place") - 1
    numbered.select("user", number.cast("bigint").alias("number")).write.format(fmt).mode("append").save(dictionary)
    return read_table(spark, dictionary, fmt)


def _seen(inits: DataFrame) -> DataFrame:
    """One init for each day, country, platform and user."""
    if "event_date" not in inits.columns:
        inits = inits.withColumn("event_date", event_date())
    return inits.select(*GROUPS, "`user-id`").distinct()


def user_bitmaps(inits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(event_date, country_name, platform, block, users): the users of each group and block of numbers as bits.

    A group whose inits all lack a user has a row without bits. Repeated users are dropped before they meet
    the dictionary, so that of a hot user only one row for each group does.
    """
    seen = _seen(inits).withColumnRenamed("user-id", "user")
    # Users without a name are few rows now, one a group.
    known, unknown = seen.filter("user is not null"), seen.filter("user is null").drop("user")
    numbers = known.join(dictionary, "user").select(*GROUPS, "number")
    numbers = numbers.unionByName(unknown.withColumn("number", F.lit(None).cast("bigint")))
    block, position = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    rows = numbers.select(*GROUPS, block.alias("block"), position.alias("position"))
    return rows.groupBy(*GROUPS, "block").agg(F.bitmap_construct_agg("position").alias("users"))


def write_user_rollup(
    spark: SparkSession,
    inits: DataFrame,
    rollup: str,
    dictionary: str,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Bring dictionary and rollup up to date with the days of ``inits``, whose rows must be whole days.

    These days are replaced, others stay. A crash in between leaves users in the dictionary that no bitmap has yet, which
    changes no count. ``inits`` are computed once: what both tables need of them, each group's users without repeats, is
    kept on the executors until both are written.
    """
    seen = _seen(inits).persist()
    try:
        numbers = add_users(spark, seen, dictionary, fmt)
        bitmaps = user_bitmaps(seen, numbers).hint("rebalance", F.col("event_date"))
        writer = bitmaps.write.format(fmt).partitionBy("event_date").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").save(rollup)
    finally:
        seen.unpersist()


def users_from_rollup(
    rollup: DataFrame, by: Sequence[str] = GROUPS, first: Day | None = None, last: Day | None = None
) -> DataFrame:
    """Exact distinct users by some of day, country and platform, over a range of days (inclusive; default all).

    Reads the rollup only, and of it only the days asked for. Without the day in ``by`` a user counts once
    for the whole range.
    """
    days = rollup.filter(_between(first, last))
    united = days.groupBy(*by, "block").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("distinct_users"))
