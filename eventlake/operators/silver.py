"""Bronze rows -> typed, cleaned silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventlake.functions.rules import apply_rules
from eventlake.plans.event_types import EventType
from eventlake.schemas import EVENT_DDL


def parse_events(bronze: DataFrame) -> DataFrame:
    """Unified payload columns plus the two bronze timestamps.

    Values of the wrong type become null; text that is not JSON becomes a row of nulls.
    """
    return bronze.select(
        F.from_json("event_json", EVENT_DDL).alias("event"),
        "ingestion_timestamp",
        "kafka_timestamp",
    ).select("event.*", "ingestion_timestamp", "kafka_timestamp")


def of_type(parsed: DataFrame, event_filter: str) -> DataFrame:
    return parsed.filter(F.col("event-type") == event_filter)


def clean(parsed: DataFrame, event_type: EventType) -> DataFrame:
    """Filter one type out of the parsed rows, preprocess and clean it."""
    df = of_type(parsed, event_type.event_filter)
    if event_type.preprocess:
        df = event_type.preprocess(df)
    return apply_rules(df, event_type.rules).withColumn(
        "processing_timestamp", F.current_timestamp()
    )


def to_silver(bronze: DataFrame, event_type: EventType) -> DataFrame:
    return clean(parse_events(bronze), event_type)


#: Column of the shared silver table that names the table a row belongs to.
TABLE = "silver_table"


def _by_type(parsed: DataFrame, event_types: Sequence[EventType]) -> tuple[DataFrame, list[str]]:
    """Every type's cleaned row as a struct column, null where the event is of another type.

    The types are cleaned one after another on the same rows; a type's steps see nulls in place of other types' events,
    so what they would make of those can neither fail nor stay. Steps must keep rows as they are.
    """
    base = parsed.columns
    df = parsed.select(F.struct(*(F.col(f"`{name}`") for name in base)).alias("_row"))
    made: list[str] = []
    for event_type in event_types:
        mine = F.col("_row")["event-type"] == event_type.event_filter
        carried = df.columns
        df = df.select("*", *(F.when(mine, F.col("_row")[name]).alias(name) for name in base))
        if event_type.preprocess:
            df = event_type.preprocess(df)
        df = apply_rules(df, event_type.rules)
        own = [F.col(f"`{name}`") for name in df.columns if name not in carried]
        made.append(f"_type{len(made)}")
        row = F.struct(*own, F.current_timestamp().alias("processing_timestamp"))
        df = df.select(*carried, F.when(mine, row).alias(made[-1]))
    return df, made


def _rows(df: DataFrame, made: Sequence[str], row: dict[str, Column]) -> DataFrame:
    """The structs of ``row`` (one for each type) that a parsed row gave, as rows."""
    each = [F.when(F.col(name).isNotNull(), row[name]) for name in made]
    return df.select(F.inline(F.array_compact(F.array(*each))))


def to_shared_silver(bronze: DataFrame, event_types: Sequence[EventType]) -> DataFrame:
    """Rows of all types from one pass that parses each bronze row once.

    Columns are those of all types together, null where a type lacks them, and ``silver_table``. An event that
    several types take gives a row for each. Of a column that several types make, the type must be the same.
    """
    df, made = _by_type(parse_events(bronze), event_types)
    fields = {name: {f.name: f.dataType for f in df.schema[name].dataType} for name in made}
    kinds: dict = {}
    for name in made:
        for field, kind in fields[name].items():
            if kinds.setdefault(field, kind) != kind:
                raise ValueError(f"event types disagree on the type of {field!r}: {kinds[field]}, {kind}")
    # As in a type's own table, the processing time comes last.
    kinds["processing_timestamp"] = kinds.pop("processing_timestamp")

    def unified(name: str, table: str) -> Column:
        value = lambda f, kind: F.col(name)[f] if f in fields[name] else F.lit(None).cast(kind)
        return F.struct(*(value(f, kind).alias(f) for f, kind in kinds.items()), F.lit(table).alias(TABLE))

    return _rows(df, made, {name: unified(name, t.silver_table) for name, t in zip(made, event_types)})


def to_shared_values(bronze: DataFrame, event_types: Sequence[EventType]) -> DataFrame:
    """What :func:`to_kafka_value` gives of every type's rows, from one pass."""
    df, made = _by_type(parse_events(bronze), event_types)
    return _rows(df, made, {name: F.struct(F.to_json(name).alias("value")) for name in made})


def to_kafka_value(silver: DataFrame) -> DataFrame:
    """All columns as one JSON ``value``; null columns are left out."""
    return silver.select(F.to_json(F.struct("*")).alias("value"))
