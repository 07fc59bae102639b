"""Starting streaming queries: table and Kafka sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventlake.operators.silver import to_kafka_value
from eventlake.sources.kafka import kafka_sink_options
from eventlake.sources.schema_log import log_schema
from eventlake.sources.tables import DEFAULT_FORMAT, path_exists

# Trigger value that processes what is there and stops; anything else is an interval.
AVAILABLE_NOW = "available now"

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query copies when it starts.

    State lives in RocksDB, off the heap, and commits upload only its changes. The number
    of state partitions is fixed by the first start of a checkpoint; by default it is the
    session's shuffle setting.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "10 seconds",
    fmt: str = DEFAULT_FORMAT,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append a stream to a table; with a checkpoint, each row lands exactly once.

    New columns are merged by table formats that support it; those of file tables go to the log of their schema.
    ``partition_by`` lays the table out in folders. ``files_per_batch`` gathers a micro-batch
    into so many files at most, in each folder if there are any, instead of one for each task; folders
    are written by all cores. Without folders, files above Spark's advisory partition size become several, so that a
    large micro-batch is written, and later read, by more than so many tasks; stateful queries keep to the number. A new checkpoint over a file table that another one has written is refused: Spark's
    file sink knows batches by number and would take the new ones for repeated ones.
    """
    spark = df.sparkSession
    if fmt != "delta" and path_exists(spark, f"{path}/_spark_metadata") and not path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} was written under another checkpoint than {checkpoint}")
    if fmt != "delta":
        log_schema(spark, path, df.schema)
    if files_per_batch and partition_by:
        part = F.pmod(F.xxhash64(*(F.col(f"`{name}`") for name in df.columns)), F.lit(files_per_batch))
        df = df.repartition(spark.sparkContext.defaultParallelism, *partition_by, part)
    elif files_per_batch and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        df = df.hint("rebalance", files_per_batch)
    elif files_per_batch:
        df = df.repartition(files_per_batch)
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer, trigger).start(path)


def publish_stream(
    silver: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: str = "10 seconds",
    enabled: bool = True,
) -> StreamingQuery | None:
    """Publish silver rows as JSON, or the values made of them, with a checkpoint apart from the table's."""
    if not enabled:
        return None
    values = silver if silver.columns == ["value"] else to_kafka_value(silver)
    writer = (
        values
        .writeStream.format("kafka")
        .outputMode("append")
        .options(**kafka_sink_options(servers, topic, f"{checkpoint}_kafka"))
    )
    return triggered(writer, trigger).start()
