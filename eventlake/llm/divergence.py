"""How far sources of a language stand apart, from run-length columns of term counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from eventlake.llm.common import map_batches, materialised, written

#: Shares are whole numbers of so many parts.
PARTS = 1_000_000_000
#: A term is kept if so many documents of its language hold it.
LEAST_DOCS = 3
#: Terms returned of a group.
TOP_TERMS = 200
#: Counts (terms times groups) that a task holds at once.
CELLS = 1 << 20
#: Different terms of a task after which their counts are passed on.
HELD = 1 << 18
#: A text is cut into words so many bytes at a time.
PIECE = 1 << 20
# Bytes that are no part of a term become spaces, A-Z become a-z; all bytes of other letters stay.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b
    for b in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, repeats included, some at a time."""
    plain, start = text.translate(_LETTERS), 0
    while start < len(plain):
        end = start + PIECE
        if end < len(plain):
            cut = plain.rfind(b" ", start, end)
            cut = cut if cut >= 0 else plain.find(b" ", end)
            end = cut if cut >= 0 else len(plain)
        yield plain[start:end].split()
        start = end + 1


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), added up per task; a group's empty term stands for the group itself."""

    def emit(held: dict[tuple, tuple[Counter, Counter]]) -> pa.RecordBatch:
        langs, sources, words, n, in_docs = [], [], [], [], []
        for (lang, source), (count, seen) in held.items():
            langs += [lang] * len(count)
            sources += [source] * len(count)
            words += count.keys()
            n += count.values()
            in_docs += [seen[word] for word in count]
        as_read = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
        columns = [pc.cast(pa.array(c, pa.binary()), options=as_read) for c in (langs, sources, words)]
        columns += [pa.array(c, pa.int64()) for c in (n, in_docs)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for row in zip(*(column.cast(pa.large_binary()) for column in batch.columns)):
                lang, source, text = (value.as_py() for value in row)
                count, seen = held.setdefault((lang, source), (Counter({b"": 0}), Counter()))
                size -= len(count)
                mine: Counter = Counter()
                for some in terms(text):
                    mine.update(some)
                count.update(mine)
                seen.update(mine.keys())
                size += len(count)
                if size > HELD:
                    yield emit(held)
                    held, size = {}, 0
        if held:
            yield emit(held)

    found = map_batches(docs, run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """``1 + floor(PARTS * (count + 1) / (total + vocabulary))``, exactly, three digits at a time.

    Holds for totals below 9 * 10 ** 15.
    """
    rest, quotient = counts + 1, np.zeros_like(counts)
    whole = total + vocabulary
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // whole
        rest = rest % whole
    return quotient + 1


class Runs:
    """A column of equal neighbours: where each run starts, and its value."""

    def __init__(self, column: np.ndarray):
        self.starts = np.flatnonzero(np.diff(column, prepend=column[:1] - 1))
        self.values = column[self.starts]
        self.length = len(column)

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.values[np.searchsorted(self.starts, places, side="right") - 1]

    def apart(self, other: Runs) -> tuple[int, int]:
        """Sums of ``floor((p - q) ** 2 / q)`` over both columns, with the other's values as q, then one's own."""
        starts = np.union1d(self.starts, other.starts)
        lengths = np.diff(starts, append=self.length)
        p, q = self.at(starts), other.at(starts)
        squared = (p - q) ** 2
        return int((squared // q * lengths).sum()), int((squared // p * lengths).sum())


def clustered(counts: np.ndarray) -> np.ndarray:
    """An order of the terms (columns) in which equal counts stand together: by the group with most terms, then the next."""
    by_terms = np.argsort(-np.count_nonzero(counts, axis=1), kind="stable")
    return np.lexsort(counts[by_terms][::-1])


def _audited(top: int):
    """Function over the rows of one language's chunk: groups with their totals, and terms with their counts."""

    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]
    )

    def run(table: pa.Table) -> pa.Table:
        lang, is_group = table["lang"][0].as_py(), pc.is_null(table["term"])
        groups = table.filter(is_group)
        sources, totals = groups["source"].to_pylist(), groups["total"].to_pylist()
        vocabulary = groups["vocabulary"][0].as_py()
        held = table.filter(pc.invert(is_group)).sort_by("term")
        counts = np.zeros((len(sources), held.num_rows), np.int64)
        if held.num_rows:
            cells = held["cells"].combine_chunks()
            which = pc.index_in(cells.flatten().field("source"), value_set=pa.array(sources)).to_numpy()
            place = np.repeat(np.arange(held.num_rows), pc.list_value_length(cells).to_numpy())
            counts[which, place] = cells.flatten().field("n").to_numpy()
        found = {name: [] for name in ("source", "part", "item", "value")}

        def add(source: int, part: str, items: list, values: list[int]) -> None:
            found["source"] += [sources[source]] * len(items)
            found["part"] += [part] * len(items)
            found["item"] += items
            found["value"] += values

        if held.num_rows:
            p = np.stack([shares(c, total, vocabulary) for c, total in zip(counts, totals)])
            order = clustered(counts)
            runs = [Runs(column[order]) for column in p]
            q = shares(counts.sum(axis=0), sum(totals), vocabulary)
            for i in range(len(sources)):
                of = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                f = (p[i, of] - q[of]) ** 2 // q[of]
                # Terms are in order of their bytes, so a stable sort leaves ties in it.
                first = np.argsort(-f, kind="stable")[:top]
                add(i, "term", held["term"].take(pa.array(of[first])).to_pylist(), f[first].tolist())
        for i in range(len(sources)):
            for j in range(i):
                there, back = runs[i].apart(runs[j]) if held.num_rows else (0, 0)
                add(i, "pair", [sources[j]], [there])
                add(j, "pair", [sources[i]], [back])
        return pa.table({"lang": [lang] * len(found["source"]), **found}, schema=schema)

    return run


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's terms are from other sources' and from the language's.

    Null texts, languages and sources are read as empty. Terms are runs of letters, every character beyond ASCII
    counting as one, with A-Z in lower case. A language keeps the terms that ``least_docs`` of its documents
    hold. With ``p`` a group's share of a kept term, smoothed by one, and ``q`` another's, in
    billionths, a distance is ``floor((p - q) ** 2 / q)``. Part ``pair`` has their sum over all kept terms for every
    other source, part ``term`` the ``top`` terms that a source has more of than its language.

    Counts are added up in tasks, then by (lang, source, term). The kept vocabulary is dealt to chunks of
    ``CELLS`` counts. In a chunk the terms are put in an order that brings equal counts together, each group's column
    becomes runs, and a pair of groups meets run by run, so the many rare terms cost one step. Chunks return
    one sum a pair and at most ``top`` terms a group. Every result grows with the square of a language's sources,
    as all pairs are asked for; terms and texts of any length and number are counted whole, repeated
    rows as often as they come. An empty table gives an empty result; other columns are ignored.
    """
    read = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = docs.select(read(lang).alias("lang"), read(source).alias("source"), read(text).alias("text"))
    # At most one cell for each source of the language; the empty term has all of them.
    by_term = _counted(rows).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    kept = materialised(by_term.filter((F.col("docs") >= least_docs) | (F.col("term") == "")).drop("docs"))
    counts = kept.select("lang", "term", F.explode("cells").alias("cell"))
    groups = counts.groupBy("lang", F.col("cell.source").alias("source")).agg(F.sum("cell.n").alias("total"))
    sizes = kept.groupBy("lang").agg(
        F.count_if(F.col("term") != "").alias("vocabulary"),
        F.max(F.when(F.col("term") == "", F.size("cells"))).alias("groups"),
    )
    chunks = F.greatest(F.lit(1), F.ceil(F.col("vocabulary") * F.col("groups") / CELLS)).cast("int")
    # One row a language, written so that Spark knows whether it is small enough to broadcast.
    sizes = written(sizes.select("lang", "vocabulary", chunks.alias("chunks")))
    everywhere = groups.join(sizes, "lang").select(
        "lang",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        "source",
        "total",
        "vocabulary",
    )
    dealt = kept.filter(F.col("term") != "").join(sizes.select("lang", "chunks"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"), "term", "cells"
    )
    work = everywhere.unionByName(dealt, allowMissingColumns=True)
    found = work.groupBy("lang", "chunk").applyInArrow(
        _audited(top), "lang string, source string, part string, item string, value bigint"
    )
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    first = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(first))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
