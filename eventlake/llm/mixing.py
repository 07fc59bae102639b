"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.llm.common import materialised, written

WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its own words.
REPEATS = 3
#: Words of a schedule's slot, about.
SLOT_WORDS = 1024
#: Parts that a running total is taken in, so that no source is one task's work.
_CHUNKS = 4096


def word_count(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _running(df: DataFrame, key: str, chunk: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the key's earlier rows, by chunk and then ``order``."""
    earlier = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = df.groupBy(key, chunk).agg(F.sum(value).alias("_sum"))
    before = sums.select(key, chunk, F.coalesce(F.sum("_sum").over(earlier), none).alias("_before"))
    total = F.col("_before") + F.coalesce(F.sum(value).over(within), none)
    return df.join(before, [key, chunk]).withColumn(name, total).drop("_before")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(number, source, source_size, target, words) for each source of (source, size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share all
    words. With caps taken in order of cap to weight, a source is capped when its cap is
    below its share of what the earlier caps leave; the largest such level is the final one.
    ``words`` is the target in whole words. The windows see one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    earlier, all_ = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    none = F.lit(0).cast("long")
    listed = F.array(*(F.lit(w).cast("long") for w in weights))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(in_order))
        .withColumn("weight", F.element_at(listed, (F.col("number") - 1) % len(weights) + 1))
        .withColumn("cap", REPEATS * F.col("source_size"))
        .withColumn("open_words", F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(earlier), none))
        .withColumn("open_weight", F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(earlier), none))
        .withColumn("level", F.max(F.col("open_words") / F.col("open_weight")).over(all_))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("words", F.least(F.floor(F.col("target") + 0.5), "cap"))
        .select("number", "source", "source_size", "target", "words")
    )


def _reversed_bits(number: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("long") if bits else number


def _ranges(targets: DataFrame, slot_words: int) -> tuple[DataFrame, int]:
    """(number, low, high, slot_size) of each source with words, and the bits of a slot's number."""
    total = max(1, targets.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0])
    bits = max(0, math.ceil(math.log2(total / slot_words)))
    until = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    edge = lambda words: F.ceil(words * F.lit(float(1 << bits)) / F.lit(float(total)))
    ranges = (
        targets.filter("words > 0")
        .withColumn("until", F.sum("words").over(until))
        .withColumn("low", edge(F.col("until") - F.col("words")))
        .withColumn("high", edge(F.col("until")))
        .withColumn("slot_size", F.ceil(F.col("words") / F.greatest(F.col("high") - F.col("low"), F.lit(1))))
        .select("number", "low", "high", "slot_size")
    )
    return ranges, bits


def schedule(targets: DataFrame, slot_words: int = SLOT_WORDS) -> DataFrame:
    """(slot, number, rank): which source each slot draws from, and its how-manieth it is there.

    Van der Corput points go through the cumulative target shares: slot j has the point
    whose binary digits are j's in reverse, so each source's slots are spread evenly over
    the schedule and their number is off by less than one from its share. A source too small
    for a slot gets one at the end. A source's slots are of equal size, except the last.
    """
    ranges, bits = _ranges(targets, slot_words)
    cell = max(0, bits - 12)  # points are looked up by one of at most 4,096 cells
    shift = lambda column: F.shiftright(column, cell)
    cells = ranges.filter("high > low").select(
        "number", "low", "high", F.explode(F.sequence(shift("low"), shift(F.col("high") - 1))).alias("cell")
    )
    points = targets.sparkSession.range(1 << bits).select(
        F.col("id").alias("slot"), _reversed_bits(F.col("id"), bits).alias("point")
    )
    drawn = points.withColumn("cell", shift("point")).join(cells, "cell").filter("point >= low and point < high")
    late = ranges.filter("high = low").select((F.col("number") + (1 << bits)).cast("long").alias("slot"), "number")
    every = drawn.select("slot", "number").unionByName(late).withColumn("chunk", shift("slot"))
    ranked = _running(every, "number", "chunk", ["slot"], F.lit(1).cast("long"), "rank")
    return ranked.select("slot", "number", "rank")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    slot_words: int = SLOT_WORDS,
    shuffle: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The placed documents and the segments that the mix takes of them.

    Documents: (key, source, size, number, source_size, target, words, start), where a source's
    documents stand in shuffled order on a line and ``start`` is the place of the first word.
    Segments: (slot, number, start, pass, first_word, taken), the words that a slot takes of a
    document; a line is read up to ``REPEATS`` times, so a document is never taken more often.
    Slots are joined to the equal blocks of the line by source and rank. Documents
    without words hold no segment. The order is that of md5 of the column ``shuffle``, by default
    the key, and the size, then the key; so reruns agree. Null texts have no words, null keys and sources
    are kept, other columns are ignored. An empty table gives empty results.
    """
    sized = materialised(
        docs.select(
            F.col(key).alias("key"),
            F.col(shuffle or key).cast("string").alias("shuffle"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
        )
    )
    # One row per source, as a table whose bytes Spark knows when it chooses the joins.
    targets = written(source_targets(sized, weights))
    named = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    shuffled = F.md5(F.concat_ws(":", "shuffle", F.col("size").cast("string")))
    chunk = F.conv(F.substring("order", 1, int(math.log2(_CHUNKS)) // 4), 16, 10).cast("int")
    named = named.withColumn("order", shuffled).withColumn("chunk", chunk)
    line = _running(named, "number", "chunk", ["order", "key", "size"], F.col("size"), "start")
    line = materialised(line.drop("order", "chunk", "shuffle"))

    size, whole, start = F.col("size"), F.col("source_size"), F.col("start")
    passes = F.sequence(F.lit(0).cast("long"), F.expr("(words - 1 - start) div source_size"))
    slots = schedule(targets, slot_words)
    steps = _ranges(targets, slot_words)[0].select("number", "slot_size")
    blocks = (
        line.filter("size > 0 and start < words")
        .select("number", "start", "size", "source_size", "words", F.explode(passes).alias("pass"))
        .withColumn("from", F.col("pass") * whole + start)
        .withColumn("to", F.least(F.col("from") + size, F.col("words")))
        .join(steps, "number")
        .withColumn("rank", F.explode(F.expr("sequence(from div slot_size, (to - 1) div slot_size)")))
        .withColumn("first", F.greatest(F.col("from"), F.col("rank") * F.col("slot_size")))
        .withColumn("last", F.least(F.col("to"), (F.col("rank") + 1) * F.col("slot_size")))
        .withColumn("first_word", F.col("first") - F.col("from"))
        .withColumn("taken", F.col("last") - F.col("first"))
        .select("number", "rank", "start", "pass", "first_word", "taken")
    )
    segments = blocks.join(slots, ["number", "rank"]).drop("rank")
    return line.withColumnRenamed("key", key), segments


def mixture(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, source, size, source_size, target, taken) of every row; see :func:`mix`."""
    line, segments = mix(docs, key, **options)
    sums = segments.groupBy("number", "start").agg(F.sum("taken").alias("taken"))
    taken = F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    columns = [key, "source", "size", "source_size", "target"]
    with_words = line.filter("size > 0").join(sums, ["number", "start"], "left").select(*columns, taken)
    without = line.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    return with_words.unionByName(without)
