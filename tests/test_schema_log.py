"""Tables whose columns change, read by the log of their schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import permutations
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.sources import schema_log
from eventlake.sources.tables import read_table, read_table_stream, scratch_dir, side_table
from eventlake.streaming.compaction import compact_days, read_compacted
from eventlake.streaming.sinks import AVAILABLE_NOW, append_stream


def shape(schema):
    return {f.name.lower(): f.dataType.simpleString() for f in schema.fields}


def of(ddl):
    return StructType.fromDDL(ddl)


def test_union_in_any_order(spark):
    parts = [of("a int, s struct<x: int>"), of("A bigint, b array<float>"), of("s struct<y: string>, b array<double>")]
    found = [shape(schema_log.united(schema_log.united(x, y), z)) for x, y, z in permutations(parts)]
    fields = found[0]["s"]
    assert fields in ("struct<x:int,y:string>", "struct<y:string,x:int>")
    for one in found:
        assert {**one, "s": ""} == {"a": "bigint", "s": "", "b": "array<double>"}
        assert one["s"] in ("struct<x:int,y:string>", "struct<y:string,x:int>")


@pytest.mark.parametrize("old,new", [("a int", "a string"), ("s struct<x: int>", "s struct<x: date>"), ("a int", "a double")])
def test_conflicts_are_refused_before_a_row_is_written(spark, old, new):
    path = scratch_dir(spark, "conflict")
    schema_log.append_table(spark.createDataFrame([], of(old)), path)
    with pytest.raises(schema_log.SchemaConflict):
        schema_log.append_table(spark.createDataFrame([], of(new)), path)
    assert shape(read_table(spark, path).schema) == shape(of(old)) == shape(schema_log.logged_schema(spark, path))


def test_later_columns_and_wider_numbers(spark):
    path = scratch_dir(spark, "wider")
    schema_log.append_table(spark.sql("SELECT 1 AS n, named_struct('x', 1) AS s, array(1.5f) AS a"), path)
    schema_log.append_table(spark.sql("SELECT 1L << 40 AS n, named_struct('x', 2, 'y', 'new') AS s, array(2.5D) AS a, 'z' AS b"), path)
    rows = schema_log.read_logged(spark, path).orderBy("n").collect()
    assert [(r.n, r.s.x, r.s.y, r.a, r.b) for r in rows] == [(1, 1, None, [1.5], None), (1 << 40, 2, "new", [2.5], "z")]


def test_no_file_is_opened_for_the_schema(spark):
    path = scratch_dir(spark, "closed")
    schema_log.append_table(spark.range(3), path)
    schema_log.append_table(spark.range(3).withColumn("added", F.lit("x")), path)
    for file in Path(path).glob("*.parquet"):
        file.write_bytes(b"no footer")
        file.with_name(f".{file.name}.crc").unlink()
    with pytest.raises(Exception):
        read_table(spark, path, merge_schema=True).columns
    assert schema_log.read_logged(spark, path).columns == ["id", "added"]


def test_an_entry_only_for_what_is_new(spark):
    path = scratch_dir(spark, "entries")
    for df in (spark.range(1), spark.range(2), spark.range(1).selectExpr("cast(id AS int) AS ID"), spark.range(1)):
        schema_log.append_table(df, path)
    assert len(list(Path(side_table(path, "schema")).iterdir())) == 1
    assert schema_log.read_logged(spark, path).count() == 5


def test_writers_at_the_same_time(spark):
    path = scratch_dir(spark, "many")
    names = [f"c{i}" for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda name: schema_log.log_schema(spark, path, of(f"id bigint, {name} string")), names))
    assert set(schema_log.logged_schema(spark, path).names) == {"id", *names}


def test_a_writer_that_fails_leaves_null_columns(spark, monkeypatch):
    path = scratch_dir(spark, "failed")
    schema_log.append_table(spark.range(2), path)
    broken = spark.range(2).withColumn("lost", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        schema_log.append_table(broken, path)
    assert [tuple(r) for r in schema_log.read_logged(spark, path).orderBy("id").collect()] == [(0, None), (1, None)]


def test_table_without_a_log(spark):
    path = scratch_dir(spark, "older")
    assert schema_log.logged_schema(spark, path) is None
    spark.range(1).write.parquet(path)
    spark.range(1).selectExpr("id", "'x' AS added").write.mode("append").parquet(path)
    assert set(schema_log.adopt(spark, path).names) == {"id", "added"}
    assert sorted(str(r.added) for r in schema_log.read_logged(spark, path).collect()) == ["None", "x"]


def test_a_stream_that_gains_a_column(spark):
    source, path, checkpoint = (scratch_dir(spark, name) for name in ("source", "grown", "checkpoint"))
    for n, columns in enumerate((["id"], ["id", "added"])):
        spark.range(n, n + 1).withColumn("added", F.lit("x")).write.mode("append").parquet(source)
        stream = read_table_stream(spark, source, "id bigint, added string").select(*columns)
        append_stream(stream, path, checkpoint, AVAILABLE_NOW).awaitTermination()
    rows = schema_log.read_logged(spark, path).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(0, None), (1, "x")]


@pytest.mark.parametrize("logged", [True, False])
def test_compaction_keeps_columns_of_all_files(spark, logged):
    path = scratch_dir(spark, "compacted")
    days = [spark.range(2).withColumn("event_date", F.lit(f"2024-01-0{n}").cast("date")) for n in (1, 2)]
    grown = days[1].withColumn("added", F.lit("x"))
    for df in (days[0], grown, days[1]):
        if logged:
            schema_log.append_table(df, path, partition_by=["event_date"])
        else:
            df.write.mode("append").partitionBy("event_date").parquet(path)
    compact_days(spark, path, "2024-01-01")
    compact_days(spark, path, "2024-01-02")
    found = read_compacted(spark, path)
    assert found.groupBy("added").count().orderBy("added").collect() == [(None, 4), ("x", 2)]
    assert sorted(found.columns) == ["added", "event_date", "id"]
