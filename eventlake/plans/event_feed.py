"""Kafka-shaped rows derived from the given ``events`` table.

The same projection serves batch and streaming reads. Each row becomes one JSON
message; ``error`` rows become broken JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values that the test feed cycles through. ZZ has no country name.
COUNTRY_CYCLE = ("US", "UK", "BR", "JP", "DE", "FR", "IN", "CN", "CA", "AU", "ZZ")
PLATFORM_CYCLE = ("iOS", "Android", "Web")
DEVICE_CYCLE = ("iPhone 14", "Galaxy S23", "Chrome")
BROKEN_JSON = "{bad"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, dealt over all cores: the given file is a single row group."""
    return _dealt(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _dealt(events: DataFrame) -> DataFrame:
    # By number: dealing rows out in turn would first sort them all in the one task that reads them.
    return events.repartition(events.sparkSession.sparkContext.defaultParallelism, "event_id")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, read in place and dealt over all cores as :func:`read_events` does.

    The path is a glob because the file source takes a single file only that way;
    it matches a folder of part files as well.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return _dealt(spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet"))


def _pick(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def _user(number: Column) -> Column:
    return F.concat(F.lit("user_"), F.lpad(number.cast("string"), 6, "0"))


def _object(*members: tuple[str, Column]) -> Column:
    return F.struct(*(value.alias(key) for key, value in members))


def _json(*members: tuple[str, Column]) -> Column:
    """JSON text with the members in the given order; null values drop their key."""
    return F.to_json(_object(*members))


def kafka_rows(events: DataFrame, with_invalid: bool = False) -> DataFrame:
    """One Kafka-shaped row per event.

    ``with_invalid`` plants schema violations, by ``event_id``, for the validator.
    """
    ts = F.col("ts").cast("timestamp")
    event_id, user = F.col("event_id"), F.col("user_id")
    event_type = F.col("event_type")
    k = F.col("k")
    fault = event_id % 97 if with_invalid else F.lit(0)

    time = F.when(fault == 1, F.lit(-1)).otherwise(F.unix_millis(ts))
    country = _pick(COUNTRY_CYCLE, user % 11)
    platform = _pick(PLATFORM_CYCLE, event_id % 3)
    extra = ("extra", F.when(fault == 2, F.lit(1)))
    user_a, user_b = _user(user), _user(user + 1 + k)

    postmatch = [
        ("coin-balance-after-match", k * 100),
        ("level-after-match", k + 1),
        ("device", _pick(DEVICE_CYCLE, k % 3)),
        ("platform", _pick(PLATFORM_CYCLE, (event_id + k) % 3)),
    ]
    init = _json(
        ("event-type", F.lit("init")),
        ("time", time),
        ("user-id", _user(user)),
        ("country", F.when(fault != 4, country)),
        ("platform", platform),
        extra,
    )
    match = _json(
        ("event-type", F.lit("match")),
        ("time", time),
        ("user-a", user_a),
        ("user-b", user_b),
        ("user-a-postmatch-info", _object(*postmatch)),
        ("user-b-postmatch-info", F.when(event_id % 7 != 0, _object(*postmatch))),
        ("winner", F.when(event_id % 2 == 0, user_a).otherwise(user_b)),
        ("game-tier", F.when(fault == 3, F.lit(9)).otherwise(k % 5 + 1)),
        ("duration", 30 + k * 5),
        extra,
    )
    purchase = _json(
        ("event-type", F.lit("in-app-purchase")),
        ("time", time),
        ("purchase_value", F.col("value")),
        ("user-id", _user(user)),
        ("product-id", F.concat(F.lit("PROD"), F.lpad((k % 12 + 1).cast("string"), 3, "0"))),
        extra,
    )
    payload = (
        F.when(event_type.isin("signup", "view"), init)
        .when(event_type == "click", match)
        .when(event_type == "purchase", purchase)
        .otherwise(F.lit(BROKEN_JSON))
    )
    topic = (
        F.when(event_type == "click", F.lit("match_events"))
        .when(event_type == "purchase", F.lit("purchase_events"))
        .otherwise(F.lit("init_events"))
    )
    with_k = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return with_k.select(
        _user(user).cast("binary").alias("key"),
        # A generator of one row: filters above do not build the message a second time.
        F.explode(F.array(payload.cast("binary"))).alias("value"),
        topic.alias("topic"),
        (event_id % 3).cast("int").alias("partition"),
        event_id.alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
