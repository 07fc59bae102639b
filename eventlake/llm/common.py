"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import pickle
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text handled at once inside a task; longer single texts are handled alone.
BLOCK_BYTES = 1 << 20
#: Rows that pass between Spark and Python at once; a longer single row passes alone.
BATCH_BYTES = 8 << 20
#: Pieces that a text too long for a sample is represented by.
PIECES = 16
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder below ``spark.checkpoint.dir`` that this session's executors share.

    A folder of this machine stands in only where the setting is absent and Spark runs
    in local mode, as in tests.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialised(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, cutting the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, whose size Spark knows when it plans."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Shipped:
    """An object for all tasks, broadcast by value: workers need no copy of the modules of this package."""

    def __init__(self, spark: SparkSession, thing: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(thing))

    @property
    def value(self):
        # A worker keeps the broadcast between tasks, and so what it unpacks to.
        if not hasattr(self._sent, "opened"):
            self._sent.opened = pickle.loads(self._sent.value)
        return self._sent.opened


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo the divisor; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def map_blocks(
    df: DataFrame,
    text: str,
    function: Callable[[list[bytes | None]], dict[str, pa.Array]],
    added: str,
) -> DataFrame:
    """All columns of ``df`` and those that ``function`` makes of the texts' UTF-8 bytes.

    ``added`` is the schema text of the new columns. A task holds one Arrow batch of
    rows and works through it in blocks of about ``BLOCK_BYTES`` of text.
    """
    refuse_clash(df.columns, [part.split()[0] for part in added.split(", ")])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), added])
    names = [*df.columns, *(part.split()[0] for part in added.split(", "))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for block in byte_blocks(batch, at):
                raw = block.column(at).cast(pa.large_binary()).to_pylist()
                made = function(raw)
                columns = [*block.columns, *made.values()]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(df, run, schema)


def refuse_clash(columns: Iterable[str], added: Iterable[str]) -> None:
    taken = {name.lower() for name in columns} & {name.lower() for name in added}
    if taken:
        raise ValueError(f"columns already there: {sorted(taken)}")


def _release() -> None:
    """Give freed memory back: idle Python workers stay beside later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(
    df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches of ``BATCH_BYTES``, so that long texts don't come ten thousand at once.

    The session's own setting is kept where its configuration names one.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _release()

    return df.mapInArrow(run, schema)


def byte_blocks(batch: pa.RecordBatch, at: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose column ``at`` holds about ``limit`` bytes each."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0)
    part = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        yield batch.slice(start, end - start)


#: The largest place that :func:`hash_slot` gives.
LAST_SLOT = 2**63 - 1


def sampled_share(rows: int, wanted: int) -> int:
    """The last place to keep so that about ``wanted`` of ``rows`` stay, at every number of rows."""
    return LAST_SLOT if rows <= wanted else wanted * (LAST_SLOT + 1) // rows


def _place(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 to ``LAST_SLOT``, its low bits first."""
    low = F.shiftleft(hashed.bitwiseAND(F.lit(0xFFFF).cast("long")), 47)
    return low.bitwiseOR(F.shiftrightunsigned(hashed, 17))


def hash_slot(*columns: Column) -> Column:
    """A row's place among ``LAST_SLOT`` + 1."""
    return _place(F.xxhash64(*columns))


def _pieces(text: str, wanted: int) -> Column:
    """The text alone or, of one above ``wanted`` bytes, pieces of about so many in all from all over it."""
    part = wanted // PIECES
    # Characters, so none is cut; the bytes of a piece are about its share of the text's.
    step = F.char_length(text) / F.lit(PIECES)
    length = F.greatest(F.lit(1), F.floor(F.char_length(text) * F.lit(part) / F.octet_length(text))).cast("int")
    cut = lambda i: F.substring(F.col(text), F.floor(i * step).cast("int") + 1, length)
    spread = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), cut)
    return F.when(F.octet_length(text) <= wanted, F.array(text)).otherwise(F.filter(spread, lambda p: p != ""))


def sample_texts(rows: DataFrame, wanted: int) -> dict[str, list[bytes]]:
    """Texts of (label, text) by label, about ``wanted`` bytes of each, in order of the text's hash.

    The sample stays of about this size as the table grows, and only it comes to the driver. A text
    that repeats under a label counts and is taken once. A label's share of hashes is doubled
    until it holds half of what it should, so each label with texts has some. Single texts above
    ``wanted`` give pieces. Nulls and empty texts are never in it.
    """
    rows = rows.filter(F.col("label").isNotNull() & (F.octet_length("text") > 0))
    size = F.least(F.octet_length("text"), F.lit(wanted)).cast("long")
    each = rows.groupBy("label", F.xxhash64("text").alias("hash")).agg(F.min(size).alias("n"))
    each = materialised(each)
    totals = {r["label"]: r["n"] for r in each.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return {}
    shares, short = {label: sampled_share(n, wanted) for label, n in totals.items()}, list(totals)
    chosen = lambda: F.element_at(
        F.create_map(*(x for label, n in shares.items() for x in (F.lit(label), F.lit(n)))), F.col("label")
    )
    while short:
        held = each.filter(_place(F.col("hash")) <= chosen()).groupBy("label").agg(F.sum("n").alias("n"))
        held = {r["label"]: r["n"] for r in held.collect()}
        short = [x for x in short if 2 * held.get(x, 0) < min(totals[x], wanted) and shares[x] < LAST_SLOT]
        shares |= {x: min(LAST_SLOT, 2 * shares[x] + 1) for x in short}
    taken = rows.filter(hash_slot(F.col("text")) <= chosen()).select("label", "text").distinct()
    found: dict[str, list[bytes]] = {}
    for label, text in taken.select("label", F.explode(_pieces("text", wanted))).collect():
        found.setdefault(label, []).append(text.encode())
    return {label: sorted(texts) for label, texts in found.items()}
