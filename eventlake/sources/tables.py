"""Reading lake tables in batch and as streams, and the job's scratch folder."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

DEFAULT_FORMAT = "parquet"


def read_table(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, merge_schema: bool = False, schema=None
) -> DataFrame:
    """Batch scan of a lake table.

    ``merge_schema`` unions the schemas of all files, so columns that appeared in
    later appends show up as null in earlier rows. It opens every file's footer; with a known ``schema`` none is.
    """
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def try_read_table(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT
) -> DataFrame | None:
    """Like :func:`read_table`, but a missing or unreadable table is logged and skipped."""
    return try_read(lambda: read_table(spark, path, fmt), path)


def try_read(read: Callable[[], DataFrame], name: str) -> DataFrame | None:
    """What ``read`` gives; None, with a log entry, where the table is missing or unreadable."""
    try:
        return read()
    except AnalysisException as error:
        log.warning("table not found at %s: %s", name, error)
    except (PySparkException, Py4JJavaError) as error:
        log.warning("cannot read table at %s: %s", name, error)
    return None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system the path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(found)


def side_table(path: str, name: str) -> str:
    """A folder beside a table's, for what belongs to it without being rows of it."""
    return f"{path.rstrip('/')}_{name}"


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema=None,
    fmt: str = DEFAULT_FORMAT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental scan of a lake table.

    File formats need a schema up front; without one it is taken from the table as
    it stands. ``delta`` tables carry their own.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema or read_table(spark, path, fmt).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables and checkpoints below ``spark.checkpoint.dir``.

    Executors on all machines must see it. A session of Spark's local mode that lacks the
    setting gets one: there driver and executors are one process.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="eventlake-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/eventlake/{name}-{uuid.uuid4().hex}"
