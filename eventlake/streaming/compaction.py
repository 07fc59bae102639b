"""Small files of past days rewritten into large ones, beside a table that streams go on writing.

Spark's file sink keeps a log of the files it wrote, which nobody else should change. So a compaction leaves them alone: it writes
the rows of some files anew under a version of its own and then adds a row to a manifest that names the version and those
files. Readers take the versions in the manifest and, of the table itself, the files that no version holds. A job that
fails before its manifest row leaves a version nobody reads; rows that come late to a compacted day are in new
files and are read at once; a further compaction takes up those files alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.functions.event_time import iso_date
from eventlake.operators.daily import Day
from eventlake.sources.schema_log import adopt, append_table, logged_schema, read_logged
from eventlake.sources.tables import DEFAULT_FORMAT, path_exists, read_table, side_table

MANIFEST_DDL = "event_date date, version string, files array<string>"
_VERSION = "_version"


def _compacted_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(versions, files they hold) of a table, as much as Spark keeps of its file listing."""
    manifest = side_table(path, "manifest")
    if not path_exists(spark, f"{manifest}/_SUCCESS"):
        return [], []
    rows = spark.read.schema(MANIFEST_DDL).parquet(manifest).collect()
    return sorted({row["version"] for row in rows}), sorted({file for row in rows for file in row["files"]})


def _left(df: DataFrame, files: list[str]) -> DataFrame:
    """The rows that no version holds; Spark drops the other files when it lists them."""
    return df.filter(~F.col("_metadata.file_path").isin(files)) if files else df


def read_compacted(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A table laid out by day, from compacted files where there are any."""
    live = read_logged(spark, path, fmt)
    versions, files = _compacted_files(spark, path) if fmt != "delta" else ([], [])
    if not versions:
        return live
    compacted = read_logged(spark, side_table(path, "compacted"), fmt)
    compacted = compacted.filter(F.col(_VERSION).isin(versions)).drop(_VERSION)
    return _left(live, files).unionByName(compacted, allowMissingColumns=True)


def compact_days(
    spark: SparkSession, path: str, first: Day, last: Day | None = None, fmt: str = DEFAULT_FORMAT
) -> int:
    """Rewrite the files of some days (inclusive) that no earlier compaction holds; returns their number.

    Rows are gathered by folder and cut into files of about the session's advisory partition size. All columns that any file has
    are kept. One compaction of a table may run at a time; streams may write and others read meanwhile.
    """
    if fmt == "delta":
        raise ValueError("delta tables have a compaction of their own")
    live = read_table(spark, path, fmt, schema=logged_schema(spark, path) or adopt(spark, path, fmt))
    folders = [name for name in ("silver_table", "event_date") if name in live.columns]
    days = F.col("event_date").between(*(F.lit(iso_date(day)).cast("date") for day in (first, last or first)))
    open_ = _left(live, _compacted_files(spark, path)[1]).filter(days)
    found = open_.select("event_date", F.col("_metadata.file_path").alias("file")).distinct()
    by_day = found.groupBy("event_date").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    files = [file for row in by_day for file in row["files"]]
    if not files:
        return 0
    version = uuid.uuid4().hex
    rows = live.filter(days & F.col("_metadata.file_path").isin(files)).withColumn(_VERSION, F.lit(version))
    gathered = rows.hint("rebalance", *(F.col(name) for name in folders))
    append_table(gathered, side_table(path, "compacted"), fmt, (_VERSION, *folders))
    entries = [(row["event_date"], version, row["files"]) for row in by_day]
    manifest = spark.createDataFrame(entries, MANIFEST_DDL).coalesce(1)
    manifest.write.mode("append").parquet(side_table(path, "manifest"))
    return len(files)
