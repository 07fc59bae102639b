"""Table and payload schemas, as DDL strings (usable without a live session)."""

# Field names, order and types of the JSON payloads.
POSTMATCH_FIELDS = ("coin-balance-after-match", "level-after-match", "device", "platform")
POSTMATCH_DDL = (
    "struct<`coin-balance-after-match`: int, `level-after-match`: int, "
    "device: string, platform: string>"
)
EVENT_DDL = f"""
    `event-type` string,
    time bigint,
    `user-id` string,
    country string,
    platform string,
    `user-a` string,
    `user-b` string,
    winner string,
    `game-tier` int,
    duration int,
    purchase_value double,
    `product-id` string,
    `user-a-postmatch-info` {POSTMATCH_DDL},
    `user-b-postmatch-info` {POSTMATCH_DDL}
"""

# Row shape delivered by Spark's Kafka connector.
KAFKA_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

# Column order of the bronze table.
BRONZE_COLUMNS = (
    "event_json",
    "ingestion_timestamp",
    "kafka_timestamp",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
)

BRONZE_DDL = (
    "event_json string, ingestion_timestamp timestamp, kafka_timestamp timestamp, "
    "kafka_topic string, kafka_partition int, kafka_offset bigint"
)

# Columns stamped with processing time; they differ on every run.
PROCESSING_TIME_COLUMNS = (
    "ingestion_timestamp",
    "processing_timestamp",
    "aggregation_timestamp",
)
