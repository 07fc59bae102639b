"""Progress metrics of streaming queries."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from eventlake.sources.tables import DEFAULT_FORMAT

PROGRESS_DDL = (
    "query_id string, name string, batch_id bigint, trigger_time string, input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, batch_duration_ms bigint, "
    "watermark string, state_rows bigint, late_rows_dropped bigint"
)


FAILURES_DDL = "query_id string, error string"


def progress_row(progress: StreamingQueryProgress) -> tuple:
    operators = progress.stateOperators or []
    return (
        str(progress.id),
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        progress.batchDuration,
        (progress.eventTime or {}).get("watermark"),
        sum(operator.numRowsTotal for operator in operators),
        sum(operator.numRowsDroppedByWatermark for operator in operators),
    )


def progress_table(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), PROGRESS_DDL)


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The micro-batches Spark still remembers for this query (100 by default)."""
    return progress_table(spark, map(progress_row, query.recentProgress))


class ProgressLog(StreamingQueryListener):
    """Appends the progress of all queries of a session to a table, and their failures to another.

    Register with ``spark.streams.addListener``. Rows are written ``rows_per_write`` at a
    time, and what is left whenever a query ends; none is dropped.
    """

    def __init__(
        self, spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, rows_per_write: int = 200
    ):
        self.spark, self.path, self.fmt, self.rows_per_write = spark, path, fmt, rows_per_write
        self.rows: list[tuple] = []

    @property
    def failures(self) -> str:
        return f"{self.path}_failures"

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self._append(progress_table(self.spark, rows), self.path)

    def _append(self, df: DataFrame, path: str) -> None:
        df.coalesce(1).write.format(self.fmt).mode("append").save(path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.append(progress_row(event.progress))
        if len(self.rows) >= self.rows_per_write:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        if event.exception:
            failed = [(str(event.id), event.exception)]
            self._append(self.spark.createDataFrame(failed, FAILURES_DDL), self.failures)


def join_state(spark: SparkSession, checkpoint: str, side: str = "right") -> DataFrame:
    """What a stopped query's join keeps of one side: the columns of its rows.

    After an interval join this is what a restart can still match. An init kept for two spans of time is one row.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    [join] = operators.filter("operatorName = 'symmetricHashJoin'").select("operatorId").distinct().collect()
    state = spark.read.format("statestore").option("operatorId", join["operatorId"]).option("joinSide", side)
    rows = state.load(checkpoint).select("value.*")
    # Without the span, inits are unique by user, country and second.
    return rows.drop("_init_span").distinct() if "_init_span" in rows.columns else rows


@contextmanager
def logged_progress(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> Iterator[ProgressLog]:
    """Log every query of the session while the block runs; afterwards all rows are in the table."""
    log = ProgressLog(spark, path, fmt)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(log)
        log.flush()
