from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan
from eventlake.functions.event_time import event_date, event_timestamp
from eventlake.operators import daily
from eventlake.sources.tables import read_table, scratch_dir

DDL = "`user-id` string, time bigint, country_name string, platform string"


def ms(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


@pytest.fixture(scope="module")
def inits(spark):
    rows = [
        ("user1", ms("2024-01-29T00:00:00"), "United States", "ANDROID"),
        ("user1", ms("2024-01-29T10:00:00"), "United States", "ANDROID"),
        ("user2", ms("2024-01-29T23:59:59.999"), "United States", "IOS"),
        ("user3", ms("2024-01-29T12:00:00"), "United Kingdom", "ANDROID"),
        ("user1", ms("2024-01-29T13:00:00"), "United States", "IOS"),
        ("user9", ms("2024-01-30T00:00:00"), "United States", "IOS"),
        ("user9", ms("2024-01-28T23:59:59.999"), "United States", "IOS"),
    ]
    return spark.createDataFrame(rows, DDL)


def counts(df):
    return {tuple(row[:-2]): row["distinct_users"] for row in df.collect()}


def test_one_day(inits):
    day = dt.date(2024, 1, 29)
    assert counts(daily.daily_users(inits, "2024-01-29")) == {
        (day, "United States", "ANDROID"): 1,
        (day, "United States", "IOS"): 2,
        (day, "United Kingdom", "ANDROID"): 1,
    }
    assert counts(daily.daily_users(inits, day)) == counts(daily.daily_users(inits, "2024-01-29"))


def test_country_totals_are_not_sums_of_platforms(inits):
    by_country = counts(daily.daily_users_by_country(daily.init_on_days(inits, "2024-01-29")))
    assert by_country[dt.date(2024, 1, 29), "United States"] == 2


def test_range_is_inclusive(inits):
    rows = daily.daily_users(inits, "2024-01-28", "2024-01-29").collect()
    assert {str(row["event_date"]) for row in rows} == {"2024-01-28", "2024-01-29"}


def test_default_is_yesterday(spark):
    now = dt.datetime.now(dt.timezone.utc)
    rows = [
        (str(back), int((now - dt.timedelta(days=back)).timestamp() * 1000), "US", "IOS")
        for back in range(3)
    ]
    [row] = daily.daily_users(spark.createDataFrame(rows, DDL)).collect()
    assert row["event_date"] == (now - dt.timedelta(days=1)).date()


@pytest.mark.parametrize("bad", ["2024-13-01", "29/01/2024", "yesterday", "", 5])
def test_malformed_date_is_refused(inits, bad):
    with pytest.raises(ValueError):
        daily.daily_users(inits, bad)


def test_time_is_truncated_toward_zero(spark):
    rows = spark.createDataFrame([(-500,), (0,), (1999,), (2**62,), (None,)], "time bigint")
    stamps = [
        row[0]
        for row in rows.select(F.unix_seconds(event_timestamp())).collect()
    ]
    assert stamps == [0, 0, 1, None, None]


def test_day_in_another_time_zone(spark, inits):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = daily.daily_users(inits, "2024-01-28").collect()
        users = daily.init_on_days(inits, "2024-01-28").select("user-id").collect()
        dates = inits.select(event_date().alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(row[0] for row in users) == ["user1", "user9"]
    assert len(rows) == 2
    assert sum(str(row["d"]) == "2024-01-28" for row in dates) == 2


def test_day_filter_reaches_the_scan(spark, inits):
    path = scratch_dir(spark, "silver-init")
    inits.write.parquet(path)
    text = plan(daily.daily_users(read_table(spark, path), "2024-01-29"))
    [pushed] = [line for line in text.splitlines() if "PushedFilters" in line]
    assert "GreaterThan(time,1706486399000)" in pushed
    assert "LessThan(time,1706572800000)" in pushed


def test_append_duplicates_and_overwrite_replaces(spark, inits):
    path = scratch_dir(spark, "daily")
    gold = daily.distinct_users(inits)
    assert daily.write_daily(gold, path) == 5
    one_day = daily.daily_users(inits, "2024-01-29")
    assert daily.write_daily(one_day, path) == 3
    assert read_table(spark, path).count() == 8
    assert daily.write_daily(one_day, path, overwrite=True) == 3
    assert read_table(spark, path).count() == 5
    [first, *_] = daily.rows_per_date(read_table(spark, path)).collect()
    assert (str(first["event_date"]), first["records"]) == ("2024-01-30", 1)
    ranked = daily.users_ranked(read_table(spark, path), "2024-01-29").collect()
    assert [row["distinct_users"] for row in ranked] == [2, 1, 1]
