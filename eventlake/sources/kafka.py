"""Kafka source and sink adapters: option building around Spark's connector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Default topics, and the topic each event type is published to.
DEFAULT_TOPICS = "init_events,match_events,purchase_events"
TOPIC_OF_EVENT_TYPE = {
    "init": "init_events",
    "match": "match_events",
    "in-app-purchase": "purchase_events",
}


def topic_list(topics: str | Sequence[str] = DEFAULT_TOPICS, legacy_topic: str = "") -> list[str]:
    """Topic names from a comma-separated setting.

    The older single-topic setting counts only when ``topics`` is empty.
    """
    if legacy_topic and not topics:
        return [legacy_topic]
    names = topics.split(",") if isinstance(topics, str) else topics
    return [name.strip() for name in names if name.strip()]


def kafka_source_options(
    servers: str,
    topics: str | Sequence[str] = DEFAULT_TOPICS,
    legacy_topic: str = "",
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = 10_000,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Options of one stream over all topics.

    By default lost offsets do not fail the query: what they held is then missing from the
    result. The rate limit delays rows and drops none; at a trigger every 10 seconds
    its default is 1,000 events a second.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_list(topics, legacy_topic)),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def legacy_source_options(servers: str, topic: str) -> dict[str, str]:
    """The older single-topic stream: always from the beginning, no rate limit."""
    return kafka_source_options(
        servers, [topic], starting_offsets="earliest", max_offsets_per_trigger=None
    )


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def kafka_sink_options(servers: str, topic: str | None, checkpoint: str) -> dict[str, str]:
    """Sink options; without ``topic`` each row's own ``topic`` column decides."""
    options = {"kafka.bootstrap.servers": servers, "checkpointLocation": checkpoint}
    if topic:
        options["topic"] = topic
    return options
