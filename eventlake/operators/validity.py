"""Validation of raw payloads and routing to topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from eventlake.functions.event_time import event_timestamp
from eventlake.functions.rules import map_values
from eventlake.functions.validation import conforms, event_type_of, violations
from eventlake.sources.kafka import TOPIC_OF_EVENT_TYPE


def validate_events(df: DataFrame, payload: str = "event_json") -> DataFrame:
    """Add ``event_type``, ``violations`` and ``is_valid`` for every payload.

    Each payload is parsed once: the generator steps keep the optimizer from copying
    the parse into every place that uses it, such as a filter on ``is_valid``. Of a key that
    occurs twice the last value counts, which Spark does by a session setting; it is set here.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    doc = F.col("_doc")
    kinds = F.struct(
        event_type_of(doc).alias("event_type"), F.schema_of_variant(doc).alias("shape")
    )
    is_valid = conforms(doc, F.col("_kinds.shape"), F.col("_kinds.event_type"))
    found = F.when(F.col("is_valid"), F.array().cast("array<string>")).otherwise(
        violations(doc, F.col("_kinds.event_type"))
    )
    return (
        df.select("*", _once(F.try_parse_json(F.col(payload))).alias("_doc"))
        .select("*", kinds.alias("_kinds"))
        .select("*", _once(is_valid).alias("is_valid"))
        .select(
            *df.columns,
            F.col("_kinds.event_type").alias("event_type"),
            found.alias("violations"),
            "is_valid",
        )
    )


def _once(expression: Column) -> Column:
    """One row in, one row out, but evaluated at this point of the plan."""
    return F.explode(F.array(expression))


def valid_events(df: DataFrame, payload: str = "event_json") -> DataFrame:
    """Only the valid rows, with their original columns."""
    return validate_events(df, payload).filter("is_valid").select(*df.columns)


def validation_summary(validated: DataFrame) -> DataFrame:
    """Generated, valid and invalid counts per event type; null: no usable type."""
    return validated.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("generated"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    )


def observe_validity(
    validated: DataFrame, metrics: Observation | str, payload: str = "event_json"
) -> DataFrame:
    """The same counters collected as a side effect of another action.

    Batch callers pass an ``Observation``; streams pass a name and read the counters
    of each micro-batch from the query progress. ``untimed`` counts valid events whose time
    lies outside the years 1-9999, or beyond 64 bits: no window or day will hold them.
    """
    time = F.get_json_object(F.col(payload), "$.time").try_cast("bigint")
    validated = validated.withColumn("_time", time)
    counted = validated.observe(
        metrics,
        F.count(F.lit(1)).alias("generated"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
        F.count_if(F.col("is_valid") & event_timestamp("_time").isNull()).alias("untimed"),
    )
    return counted.drop("_time")


def route_topics(
    df: DataFrame, payload: str = "event_json", topic: str | None = None
) -> DataFrame:
    """``topic`` and ``value`` for the Kafka sink.

    An explicit topic takes every row. Otherwise the event type decides and rows with
    a missing or unmapped type are not published.
    """
    if topic:
        return df.select(F.lit(topic).alias("topic"), F.col(payload).alias("value"))
    event_type = F.get_json_object(F.col(payload), "$['event-type']")
    return df.select(
        map_values(event_type, TOPIC_OF_EVENT_TYPE).alias("topic"),
        F.col(payload).alias("value"),
    ).filter("topic is not null")
