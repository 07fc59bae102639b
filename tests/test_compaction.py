"""Compaction of past days beside a table that is still written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventlake.schemas import BRONZE_DDL
from eventlake.sources.tables import read_table, scratch_dir
from eventlake.streaming import compaction, jobs, supervise
from eventlake.streaming.sinks import AVAILABLE_NOW

BASE = 1_704_067_200
DAYS = ("2024-01-01", "2024-01-02")


@pytest.fixture
def lake(spark):
    return jobs.Lake(scratch_dir(spark, "lake"), files_per_batch=3)


def arrive(spark, lake, offsets):
    """A micro-batch of inits and purchases over three days."""
    payload = '{"event-type":"%s","time":%d,"user-id":"u%d"}'
    data = [
        (payload % (kind, (BASE + 86400 * (n % 3)) * 1000 + n, n), None, None, "t", 0, n)
        for n in offsets
        for kind in ("init", "in-app-purchase")
    ]
    spark.createDataFrame(data, BRONZE_DDL).coalesce(1).write.mode("append").parquet(lake.table("bronze"))
    supervise.await_all(jobs.run_silver(spark, lake, AVAILABLE_NOW))


def times(df):
    return sorted(row["time"] for row in df.select("time").collect())


def files(df, days=DAYS):
    return {r[0] for r in df.filter(F.col("event_date").isin(*days)).select("_metadata.file_path").collect()}


def test_same_rows_from_fewer_files(spark, lake):
    for start in (0, 100, 200):
        arrive(spark, lake, range(start, start + 100))
    before = times(lake.read(spark, "silver-init"))
    live = read_table(spark, lake.table("silver"))
    small = files(live)
    assert lake.compact(spark, "silver-init", *DAYS) == len(small) > 2 * 2 * 2
    assert times(lake.read(spark, "silver-init")) == before == times(lake.read(spark, "silver-purchase"))
    folder = read_table(spark, lake.table("silver") + "_compacted")
    assert len(files(folder)) == 2 * 2  # A file for each type and day.
    assert files(live) == small  # What streams wrote stays.
    seen = compaction._left(live, compaction._compacted_files(spark, lake.table("silver"))[1])
    assert files(seen) == set() and files(seen, ["2024-01-03"])
    assert lake.compact(spark, "silver-init", *DAYS) == 0


def test_late_rows_are_seen_and_taken_up(spark, lake):
    arrive(spark, lake, range(50))
    lake.compact(spark, "silver-init", *DAYS)
    arrive(spark, lake, range(50, 80))
    expected = sorted((BASE + 86400 * (n % 3)) * 1000 + n for n in range(80))
    assert times(lake.read(spark, "silver-init")) == expected
    assert lake.compact(spark, "silver-init", *DAYS) > 0
    assert times(lake.read(spark, "silver-init")) == expected
    assert lake.read_stream(spark, "silver-init").isStreaming


def test_a_crash_before_the_manifest_changes_nothing(spark, lake, monkeypatch):
    arrive(spark, lake, range(60))
    before = times(lake.read(spark, "silver-init"))

    class Lost(Exception):
        pass

    def fail(*_):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", fail)
        with pytest.raises(Lost):
            lake.compact(spark, "silver-init", *DAYS)
    assert read_table(spark, lake.table("silver") + "_compacted").count() > 0
    assert times(lake.read(spark, "silver-init")) == before
    assert lake.compact(spark, "silver-init", *DAYS) > 0
    assert times(lake.read(spark, "silver-init")) == before
    assert jobs.run_daily(spark, lake, *DAYS) > 0


def test_only_tables_by_day(spark):
    with pytest.raises(ValueError):
        jobs.Lake("x", by_day=False).compact(spark, "bronze", "2024-01-01")
    with pytest.raises(ValueError):
        compaction.compact_days(spark, "x", "2024-01-01", fmt="delta")
