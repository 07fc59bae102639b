from __future__ import annotations

import pytest

from eventlake.sources import kafka
from eventlake.sources.tables import read_table, scratch_dir, try_read_table


@pytest.mark.parametrize(
    "topics,legacy,expected",
    [
        ("a, b ,,c", "", ["a", "b", "c"]),
        ("", "old", ["old"]),
        ("a", "old", ["a"]),
        ("", "", []),
        (["a", " b"], "", ["a", "b"]),
    ],
)
def test_topic_list(topics, legacy, expected):
    assert kafka.topic_list(topics, legacy) == expected


def test_source_options():
    assert kafka.kafka_source_options("host:9092") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "init_events,match_events,purchase_events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10000",
    }
    legacy = kafka.legacy_source_options("host:9092", "events")
    assert legacy["startingOffsets"] == "earliest" and legacy["subscribe"] == "events"
    assert "maxOffsetsPerTrigger" not in legacy


def test_sink_options():
    assert kafka.kafka_sink_options("h", "t", "c")["topic"] == "t"
    assert "topic" not in kafka.kafka_sink_options("h", None, "c")


def test_guarded_read(spark, tmp_path):
    assert try_read_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken.parquet").write_text("not parquet")
    assert try_read_table(spark, str(tmp_path / "broken.parquet")) is None
    spark.range(2).write.parquet(str(tmp_path / "good"))
    assert try_read_table(spark, str(tmp_path / "good")).count() == 2


def test_merged_read(spark):
    path = scratch_dir(spark, "merge")
    spark.range(1).write.parquet(path)
    spark.range(1).selectExpr("id", "'x' AS added").write.mode("append").parquet(path)
    rows = read_table(spark, path, merge_schema=True).collect()
    assert sorted(str(row["added"]) for row in rows) == ["None", "x"]


def test_scratch_dir_is_shared_and_fresh(spark):
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
