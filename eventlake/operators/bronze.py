"""Kafka rows -> bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventlake.schemas import BRONZE_COLUMNS


def to_bronze(kafka: DataFrame) -> DataFrame:
    """Payload as text plus Kafka metadata and the ingestion time; the key is dropped."""
    return kafka.select(
        F.col("value").cast("string").alias("event_json"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    ).select(*BRONZE_COLUMNS)


def to_bronze_legacy(kafka: DataFrame) -> DataFrame:
    """The older single-topic layout: keeps the key, leaves metadata unprefixed."""
    return kafka.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    ).withColumn("ingestion_timestamp", F.current_timestamp())


def drop_unparseable(bronze: DataFrame, column: str = "event_json") -> DataFrame:
    """Keep rows whose payload is JSON; of a repeated key the last value counts."""
    bronze.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return bronze.filter(F.try_parse_json(F.col(column)).isNotNull())


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Add a literal enrichment column."""
    return df.withColumn(name, F.lit(value))
