"""The schema of a file table, kept beside it, so that no read has to open footers to find columns that came later.

Each writer adds an entry with its columns before it writes, unless entries hold them already; readers unite all entries. Entries
are folders of their own and their union has the same columns in any order, so writers may add theirs at the same time. An entry
whose writer fails only names columns that are null everywhere. Table formats with a log of their own need none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from eventlake.sources.tables import DEFAULT_FORMAT, path_exists, read_table, side_table

ENTRY_DDL = "added_at timestamp, fields string"
#: Values that Spark's Parquet reader widens while it reads.
WIDER = [("tinyint", "smallint", "int", "bigint"), ("float", "double")]


class SchemaConflict(ValueError):
    """Columns of one name whose types no reader can bring together."""


def _wider(left: DataType, right: DataType, name: str) -> DataType:
    if left == right:
        return left
    if isinstance(left, StructType) and isinstance(right, StructType):
        return united(left, right, f"{name}.")
    if isinstance(left, ArrayType) and isinstance(right, ArrayType):
        return ArrayType(_wider(left.elementType, right.elementType, f"{name}.element"))
    if isinstance(left, MapType) and isinstance(right, MapType):
        key = _wider(left.keyType, right.keyType, f"{name}.key")
        return MapType(key, _wider(left.valueType, right.valueType, f"{name}.value"))
    names = left.simpleString(), right.simpleString()
    for chain in WIDER:
        if {*names} <= {*chain}:
            return max(left, right, key=lambda kind: chain.index(kind.simpleString()))
    raise SchemaConflict(f"column {name} is {names[0]} in the table and {names[1]} in what is written")


def united(left: StructType, right: StructType, prefix: str = "") -> StructType:
    """All fields of both, those of ``left`` first; nested fields are united too, numbers take the wider type.

    Names are compared without case, as Spark resolves them. Every field is nullable, as files may lack it.
    """
    fields = {f.name.lower(): f for f in left.fields}
    for field in right.fields:
        mine = fields.setdefault(field.name.lower(), field)
        kind = _wider(mine.dataType, field.dataType, prefix + mine.name)
        fields[field.name.lower()] = StructField(mine.name, kind)
    return StructType([StructField(f.name, f.dataType) for f in fields.values()])


def logged_schema(spark: SparkSession, path: str) -> StructType | None:
    """The columns of every write so far, in the order in which they came; None without a log."""
    folder = side_table(path, "schema")
    if not path_exists(spark, folder):
        return None
    # One row for each change of the columns.
    entries = spark.read.schema(ENTRY_DDL).parquet(f"{folder}/*").collect()
    entries.sort(key=lambda entry: (entry["added_at"], entry["fields"]))
    schemas = [StructType.fromJson(json.loads(entry["fields"])) for entry in entries]
    return reduce(united, schemas, StructType()) if schemas else None


def log_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Add ``schema`` to the log of a table, unless it brings nothing new; returns the table's columns.

    Types that cannot be brought together raise :class:`SchemaConflict`, before any row is written.
    """
    known = logged_schema(spark, path)
    whole = united(known or StructType(), schema)
    if known != whole:
        entry = spark.range(1).select(F.current_timestamp().alias("added_at"), F.lit(schema.json()).alias("fields"))
        entry.write.parquet(f"{side_table(path, 'schema')}/{uuid.uuid4().hex}")
    return whole


def adopt(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> StructType:
    """Start the log of a table written without one; this once, the footers of all its files are read."""
    return log_schema(spark, path, read_table(spark, path, fmt, merge_schema=True).schema)


def read_logged(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A table with all columns it ever got, null where a file lacks them; no file is opened before Spark scans it.

    Columns that a writer did not log are not seen until :func:`adopt` is run. A table without a log has the columns of one of
    its files, as Spark reads it.
    """
    return read_table(spark, path, fmt, schema=logged_schema(spark, path) if fmt != "delta" else None)


def append_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()) -> None:
    """Append rows whose columns may differ from the table's."""
    if fmt != "delta":
        log_schema(df.sparkSession, path, df.schema)
    df.write.format(fmt).mode("append").option("mergeSchema", "true").partitionBy(*partition_by).save(path)
