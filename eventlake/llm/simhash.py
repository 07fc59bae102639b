"""Near-duplicates by SimHash fingerprints and an exact, tiled comparison."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product
from math import acos, ceil, comb, log, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventlake.llm.common import map_batches, map_blocks, materialised, written
from eventlake.llm.components import components

RADIUS = 2
WORDS = 3
SEED = 42
#: Fingerprints are cut into so many parts; a tile is one population count for each.
PARTS = 4
#: Fingerprints of one tile that a task compares with others at once.
TILE_ROWS = 4096
#: The same for wide fingerprints, whose tiles are larger.
WIDE_TILE_ROWS = 1 << 15
WIDE_BYTES = 64
#: Shingle sets of owners, in bytes, that a task compares with others at once.
CELL_BYTES = 64 << 20
#: Numbers of shingles in one tile differ by less than this factor, one by the similarity.
SIZE_STEP = 1.25
#: Deviations that the radius of wide fingerprints leaves above the mean: about one pair in 10 ** 9 lies beyond.
DEVIATIONS = 6
#: From this many shingles on, the radius no longer depends on their number.
_LARGE = 100
_CHUNK = 1 << 16
_WIDTH = 64 // PARTS


def fingerprint(text: bytes, words: int = WORDS) -> bytes:
    """Eight bytes, most significant first: the bits set in over half of the shingles.

    ``bytes.lower`` and ``bytes.split`` act on A-Z and on the six ASCII spaces only.
    """
    found = text.lower().split()
    if not found:
        return bytes(8)
    shingles = max(1, len(found) - words + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_digest, b" ".join
    for i in range(0, shingles, _CHUNK):
        part = found[i : i + _CHUNK + words - 1]
        lines = map(join, zip(*(part[k:] for k in range(words)))) if len(part) >= words else [join(part)]
        hashes = np.frombuffer(b"".join([digest(line, SEED) for line in lines]), np.uint8)
        ones += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > shingles).tobytes()


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """All columns of ``docs`` but the text, and ``fingerprint`` as a long.

    A null text counts as an empty one, whose fingerprint is zero.
    """

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        prints = b"".join(fingerprint(t or b"", words) for t in texts)
        return {"fingerprint": pa.array(np.frombuffer(prints, ">u8").astype(np.uint64).view(np.int64))}

    return map_blocks(docs, text, run, "fingerprint bigint").drop(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _counts(fingerprint: str) -> list[Column]:
    part = [F.shiftrightunsigned(F.col(fingerprint), _WIDTH * i) for i in range(PARTS)]
    return [F.bit_count(p.bitwiseAND(F.lit((1 << _WIDTH) - 1))) for p in part]


def _tile(counts: list[Column]) -> Column:
    number = counts[0]
    for count in counts[1:]:
        number = number * (_WIDTH + 1) + count
    return number.cast("int")


class Forest:
    """Which owners of a tile hang together so far; keeps a link only if it joins two sets."""

    def __init__(self, owners: int):
        self.label = np.arange(owners)

    def links(self, close: np.ndarray, own: int | None = None) -> list[int]:
        """Owners that one row must be linked to, given the owners close to it; ``own`` is the row's place."""
        labels, first = np.unique(self.label[close], return_index=True)
        keep = close[first] if own is None else close[first[labels != self.label[own]]]
        self.join(labels)
        return keep.tolist()

    def join(self, labels: np.ndarray) -> None:
        """Make the sets of these distinct labels one."""
        if len(labels) > 1:
            self.label[np.isin(self.label, labels[1:])] = labels[0]


def _edges(*columns: np.ndarray) -> list[int]:
    """Starts of the runs of equal values, and the end."""
    change = np.any([np.diff(c) != 0 for c in columns], axis=0)
    return [0, *(np.flatnonzero(change) + 1).tolist(), len(columns[0])]


def _links_in_tiles(radius: int):
    """Function over rows (tile, chunk, guest, fingerprint) sorted in this order, owners first.

    Tasks hold the owners of one tile's chunk and a batch of rows.
    """

    def compare(owners: np.ndarray, rows: np.ndarray, forest: Forest, place: int | None) -> list[tuple[int, int]]:
        found, step = [], max(1, (1 << 21) // max(1, len(owners)))
        for i in range(0, len(rows), step):
            near = np.bitwise_count(owners[:, None] ^ rows[None, i : i + step]) <= radius
            for j in np.flatnonzero(near.any(axis=0)).tolist():
                own = None if place is None else place + i + j
                found += ((k, i + j) for k in forest.links(np.flatnonzero(near[:, j]), own))
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, owners, forest = None, None, None
        for batch in batches:
            tile, chunk, guest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            prints = batch.column(3).to_numpy().view(np.uint64)
            edges = _edges(tile, chunk, guest)
            links: list[np.ndarray] = []
            for start, end in zip(edges, edges[1:]):
                if end == start:
                    continue
                if key != (key := (tile[start], chunk[start])):
                    owners, forest = prints[:0], Forest(0)
                rows, place = prints[start:end], None
                if not guest[start]:
                    # Owners can come in two batches; earlier ones keep their places.
                    place = len(owners)
                    owners = np.concatenate([owners, rows])
                    forest.label = np.concatenate([forest.label, np.arange(place, len(owners))])
                links += (np.stack([owners[k], rows[j]]) for k, j in compare(owners, rows, forest, place))
            if links:
                both = np.stack(links).view(np.int64)
                ends = [pa.array(np.ascontiguousarray(both[:, i])) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, names=["u", "v"])

    return run


def _deal(spread: DataFrame, sizes: DataFrame, *more: str) -> DataFrame:
    """(tile, chunk, guest, fingerprint) sorted so, of (fingerprint, home, tile) rows, where ``home`` is the fingerprint's own tile.

    ``sizes`` has the chunks of each tile that has owners; its size is bounded. Owners visit
    the later chunks of their own tile, other fingerprints all chunks of the tile.
    """
    own = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    first = F.when(F.col("tile") == F.col("home"), own).otherwise(F.lit(0))
    work = (
        spread.join(F.broadcast(sizes), "tile")
        .withColumn("first", first)
        .withColumn("chunk", F.explode(F.sequence("first", F.col("chunks") - 1)))
        .withColumn("guest", ((F.col("tile") != F.col("home")) | (F.col("chunk") != F.col("first"))).cast("int"))
        .select("tile", "chunk", "guest", "fingerprint", *more)
    )
    return work.repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "guest")


def _dealt(prints: DataFrame) -> DataFrame:
    """Spread anew: a row becomes many, and small partitions have been merged before."""
    # By a hash, as dealing by the column itself would be found done already and left out.
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prints.repartition(n, F.xxhash64("fingerprint"))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) of the distinct longs in ``fingerprint``: links that join all at most ``radius`` bits apart.

    A tile holds the fingerprints with the same population counts of their four parts.
    Each differing bit changes one count by one, so only tiles whose counts differ by at
    most ``radius`` in all are compared: with at most 40 neighbours, half of which visit,
    each pair of tiles meets once. A large tile is split into chunks; visitors, and the
    fingerprints of the tile's earlier chunks, come to each. Every pair is compared exactly;
    of the pairs found in a chunk those are returned that connect what was not connected there.
    """
    steps = [s for s in product(range(-radius, radius + 1), repeat=PARTS) if 0 < sum(map(abs, s)) <= radius]
    steps = [s for s in steps if s > (0,) * PARTS]
    counts = [c.alias(f"c{i}") for i, c in enumerate(_counts("fingerprint"))]
    base = _dealt(prints).select("fingerprint", *counts)
    home = [F.col(f"c{i}") for i in range(PARTS)]
    moved = [[h + d for h, d in zip(home, s)] for s in steps]
    visits = [F.when((F.least(*m) >= 0) & (F.greatest(*m) <= _WIDTH), _tile(m)) for m in moved]
    spread = base.select(
        "fingerprint", _tile(home).alias("home"), F.explode(F.array(_tile(home), *visits)).alias("tile")
    ).filter("tile is not null")
    # At most 17 ** 4 tiles, so this table is below 2 MB at every size of the input.
    sizes = base.groupBy(_tile(home).alias("tile")).agg(
        F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("chunks")
    )
    return map_batches(_deal(spread, sizes), _links_in_tiles(radius), "u bigint, v bigint")


def _shingles(text: bytes, words: int) -> Iterator[set[bytes]]:
    """The distinct shingles of each part of a text; a shingle can come in several parts."""
    found = text.lower().split()
    for i in range(0, max(1, len(found) - words + 1) if found else 0, _CHUNK):
        part = found[i : i + _CHUNK + words - 1]
        yield set(map(b" ".join, zip(*(part[k:] for k in range(words))))) if len(part) >= words else {b" ".join(part)}


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    digest = xxhash.xxh3_64_digest
    hashes = b"".join([digest(line, SEED) for lines in _shingles(text, words) for line in lines])
    return np.unique(np.frombuffer(hashes, ">i8").astype(np.int64))


def wide_fingerprint(text: bytes, words: int) -> tuple[bytes, int]:
    """A fingerprint of ``WIDE_BYTES`` over distinct shingles and 16 bytes of the set's own, and the set's size.

    So texts have equal results only if their sets of shingles are equal.
    """
    digest, seeds = xxhash.xxh3_128_digest, range(SEED, SEED + WIDE_BYTES // 16)
    hashes = b"".join([digest(line, seed) for lines in _shingles(text, words) for line in lines for seed in seeds])
    rows = np.unique(np.frombuffer(hashes, f"V{WIDE_BYTES}"))
    ones = np.zeros(8 * WIDE_BYTES, np.int64)
    for i in range(0, len(rows), _CHUNK):
        bits = np.unpackbits(rows[i : i + _CHUNK].view(np.uint8).reshape(-1, WIDE_BYTES), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(rows)).tobytes() + digest(rows.tobytes(), SEED), len(rows)


def _differing_share(common: int, first: int, second: int) -> float:
    """Chance that a bit differs between two sets with so many shingles in common and of their own."""

    def ones(n: int) -> np.ndarray:
        return np.array([comb(n, i) / 2**n for i in range(n + 1)])

    def over(own: int) -> np.ndarray:
        # Set if more than half of all are ones, given those of the common shingles; a tie is not.
        tail = np.append(np.cumsum(ones(own)[::-1])[::-1], 0.0)
        return tail[np.clip((common + own) // 2 + 1 - np.arange(common + 1), 0, own + 1)]

    a, b = over(first), over(second)
    return float((ones(common) * (a * (1 - b) + b * (1 - a))).sum())


def wide_radius(similarity: float, size: int, deviations: float = DEVIATIONS) -> int:
    """Bits in which fingerprints of sets this alike differ at most, the smaller set having ``size`` shingles or more.

    Bits are independent, so their number is binomial; its chance is worked out for the sets least
    alike, as majorities of few shingles differ more often than the angle of large sets says.
    """
    size, share = max(1, min(size, _LARGE)), acos(2 * similarity / (1 + similarity)) / pi
    for whole in range(size, 2 * size + 8):
        most = int(whole * (1 - similarity) + 1e-9)
        for own in {most, max(0, most - 1)}:
            for first in {0, own // 4, own // 2}:
                share = max(share, _differing_share(whole - own, first, own - first))
    bits = 8 * WIDE_BYTES
    return ceil(bits * share + deviations * (bits * share * (1 - share)) ** 0.5)


_DENSE = WIDE_BYTES // 8 * 5 // 8


def _near(owners: np.ndarray, rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, owner) of the pairs within the radius; beyond it in the first words already ends a count."""
    total = np.zeros((len(rows), owners.shape[1]), np.uint16)
    for i in range(_DENSE):
        total += np.bitwise_count(rows[:, i, None] ^ owners[i])
    j, k = np.nonzero(total <= radius)
    count = total[j, k].astype(np.int64)
    for i in range(_DENSE, owners.shape[0]):
        count += np.bitwise_count(rows[j, i] ^ owners[i, k])
    return j[count <= radius], k[count <= radius]


def _words(nodes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(n[:WIDE_BYTES] for n in nodes), np.uint64).reshape(-1, WIDE_BYTES // 8)


class Owners:
    """The owners of one chunk so far, and the pairs that further rows make with them."""

    def __init__(self):
        self.prints = np.zeros((WIDE_BYTES // 8, 0), np.uint64)

    def pairs(self, prints: np.ndarray, guest: bool, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (row, owner) within the radius, some rows at a time; rows that are no guests become owners first."""
        place = self.prints.shape[1]
        if not guest:
            # Owners can come in two batches; earlier ones keep their places.
            self.prints = np.ascontiguousarray(np.concatenate([self.prints, prints.T], axis=1))
        step = max(1, (1 << 17) // max(1, self.prints.shape[1]))
        for i in range(0, len(prints), step):
            j, k = _near(self.prints, prints[i : i + step], radius)
            j += i
            yield (j, k) if guest else (j[k < place + j], k[k < place + j])


def _flagged_in_tiles(radii: list[int]):
    """Function over rows (tile, chunk, guest, fingerprint, size) sorted so, owners first: those with a pair within the radius."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        for batch in batches:
            tile, chunk, guest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edges = _edges(tile, chunk, guest) if batch.num_rows else [0]
            for start, end in zip(edges, edges[1:]):
                if key != (key := (tile[start], chunk[start])):
                    owners, held, seen = Owners(), [], np.zeros(0, bool)
                rows = batch.slice(start, end - start)
                radius, place = radii[min(int(tile[start]), len(radii) - 1)], len(seen)
                if not guest[start]:
                    held.append(rows)
                    seen = np.append(seen, np.zeros(len(rows), bool))
                hit, hit_rows = np.zeros(len(seen), bool), np.zeros(len(rows), bool)
                for j, k in owners.pairs(_words(rows.column(3).to_pylist()), bool(guest[start]), radius):
                    hit[k] = hit_rows[j] = True
                if not guest[start]:
                    hit[place:] |= hit_rows
                elif hit_rows.any():
                    yield rows.take(pa.array(np.flatnonzero(hit_rows)))
                new = np.flatnonzero(hit & ~seen)
                seen |= hit
                first = 0
                for part in held if len(new) else []:
                    mine = new[(new >= first) & (new < first + len(part))] - first
                    if len(mine):
                        yield part.take(pa.array(mine))
                    first += len(part)

    return run


def _common(mine: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many of its members each of the others, sorted and not empty, shares with a sorted set."""
    flat = np.concatenate(others)
    place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
    starts = np.cumsum([0, *(len(o) for o in others[:-1])])
    return np.add.reduceat((mine[place] == flat).astype(np.int64), starts)


def _alike(
    mine: np.ndarray, close: np.ndarray, sets: list[np.ndarray], forest: Forest, own: int | None, similarity: float
) -> list[int]:
    """Owners to link a row to: one of each set of owners hanging together that holds one alike.

    Of every such set some owners are measured, then four times as many of the sets still open, so that
    a group of copies costs a row one measurement and only what is refused is measured in full.
    """
    found, joined, labels, some = [], [], forest.label[close], 1
    if own is not None:
        joined.append(forest.label[own])
        close, labels = close[labels != joined[0]], labels[labels != joined[0]]
    order = np.argsort(labels, kind="stable")
    close, labels = close[order], labels[order]
    while len(close):
        now = np.arange(len(close)) - np.searchsorted(labels, labels) < some
        now[max(1, _CHUNK // len(mine)) :] = False
        asked, theirs = close[now], labels[now]
        sizes = np.array([len(sets[k]) for k in asked])
        common = _common(mine, [sets[k] for k in asked])
        yes = common / (len(mine) + sizes - common) >= similarity
        linked, first = np.unique(theirs[yes], return_index=True)
        found += asked[yes][first].tolist()
        joined += linked.tolist()
        left = ~now & ~np.isin(labels, linked)
        close, labels, some = close[left], labels[left], 4 * some
    forest.join(np.unique(joined))
    return found


def _alike_in_cells(radii: list[int], similarity: float):
    """Function over rows (tile, chunk, part, guest, fingerprint, shingles) sorted so: links that join all pairs alike."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, None
        for batch in batches:
            tile, chunk, part, guest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            nodes, lists = batch.column(4).to_pylist(), batch.column(5)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            edges = _edges(tile, chunk, part, guest) if nodes else [0]
            for start, end in zip(edges, edges[1:]):
                if key != (key := (tile[start], chunk[start], part[start])):
                    owners, owned, sets, forest, last = Owners(), [], [], Forest(0), None
                # Null keys can give a text several times; it stands beside itself.
                rows = [i for i in range(start, end) if last != (last := (guest[i], nodes[i]))]
                mine = [nodes[i] for i in rows]
                held = [values[at[i] : at[i + 1]] for i in rows]
                place = None if guest[start] else len(owned)
                if place is not None:
                    owned += mine
                    sets += (h.copy() for h in held)
                    forest.label = np.append(forest.label, np.arange(place, len(owned)))
                links = []
                radius = radii[min(int(tile[start]), len(radii) - 1)]
                for j, k in owners.pairs(_words(mine), bool(guest[start]), radius):
                    first = np.flatnonzero(np.diff(j, prepend=-1))
                    for row, close in zip(j[first].tolist(), np.split(k, first[1:])):
                        own = None if place is None else place + row
                        links += ((owned[x], mine[row]) for x in _alike(held[row], close, sets, forest, own, similarity))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(e, pa.binary()) for e in zip(*links)], ["u", "v"])

    return run


def _flagged(prints: DataFrame, radii: list[int]) -> DataFrame:
    """(tile, chunk, guest, fingerprint, size) of the distinct (fingerprint, size) with a wide fingerprint within the radius.

    Here the radius is too large for counts of bits to tell tiles apart, so a tile holds texts with
    about the same number of distinct shingles: of two sets with similarity 0.8 the larger has at most
    ``SIZE_STEP`` times as many, so a tile's fingerprints visit the next one. A fingerprint is returned once
    for every chunk in which it has a pair, however many.
    """
    level = F.floor(F.log(SIZE_STEP, F.greatest("size", F.lit(1)))).cast("int")
    base = _dealt(prints).select("fingerprint", "size", level.alias("home"))
    spread = base.select("*", F.explode(F.array("home", F.col("home") + 1)).alias("tile"))
    # A few hundred tiles at most, as sizes are longs.
    sizes = base.groupBy(F.col("home").alias("tile")).agg(
        F.ceil(F.count("*") / WIDE_TILE_ROWS).cast("int").alias("chunks")
    )
    work = _deal(spread, sizes, "size")
    return map_batches(work, _flagged_in_tiles(radii), "tile int, chunk int, guest int, fingerprint binary, size bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """(key, fingerprint, component_id) of each row; the component's id is its smallest key.

    Fingerprints at most ``radius`` bits apart are linked, and links chain. Equal
    fingerprints are compared once, however many rows share them. Null and empty texts
    have fingerprint zero. A null key stays null and is never a component's id; a component
    of null keys alone has a null id. Repeated rows come back as often as they came in.
    """
    prints = materialised(fingerprints(docs.select(F.col(key), F.col(text)), text, words))
    nodes = prints.groupBy("fingerprint").agg(F.min(key).alias("least"))
    found = _grouped(prints, nodes, links(nodes, radius), key)
    return found.select(key, hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def _grouped(prints: DataFrame, nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``prints``."""
    roots = materialised(components(edges))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(ids, "root").select("fingerprint", "component_id")
    return prints.join(members, "fingerprint").select(key, "fingerprint", "component_id")


def _shingle_links(
    docs: DataFrame, nodes: DataFrame, flagged: DataFrame, radii: list[int], words: int, similarity: float
) -> DataFrame:
    """(u, v) of fingerprints whose shingle sets have this Jaccard similarity: links that join all such pairs of a chunk.

    ``docs`` has (key, text), ``nodes`` the ``pick`` of each fingerprint: which text to take its set from. The sets
    of a chunk's flagged owners are cut into parts of about ``CELL_BYTES``; the set of an owner
    visits the later parts, a guest's all of them.
    """

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        return {"shingles": pa.array([shingle_set(t or b"", words) for t in texts], pa.list_(pa.int64()))}

    owners = flagged.filter("guest = 0").groupBy("tile", "chunk")
    parts = written(owners.agg(F.ceil(F.sum("size") * 8 / CELL_BYTES).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("fingerprint", F.lit("part")), F.col("parts")).cast("int")
    visits = (
        flagged.join(parts, ["tile", "chunk"])
        .withColumn("first", F.when(F.col("guest") == 0, own).otherwise(F.lit(0)))
        .withColumn("part", F.explode(F.sequence("first", F.col("parts") - 1)))
        .withColumn("guest", F.when(F.col("part") == F.col("first"), F.col("guest")).otherwise(F.lit(1)))
        .groupBy("fingerprint")
        .agg(F.collect_list(F.struct("tile", "chunk", "part", "guest")).alias("cells"))
    )
    picked = visits.join(nodes, "fingerprint").select("fingerprint", "cells", "pick.*")
    held = docs.select(F.col("key").alias("_key"), "text", F.xxhash64("text").alias("_mark"))
    texts = held.join(picked, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_mark") == F.col("mark")))
    sets = map_blocks(texts.select("fingerprint", "cells", "text"), "text", run, "shingles array<bigint>")
    work = sets.select(F.explode("cells").alias("cell"), "fingerprint", "shingles")
    work = work.select("cell.*", "fingerprint", "shingles").repartition("tile", "chunk", "part")
    work = work.sortWithinPartitions("tile", "chunk", "part", "guest", "fingerprint")
    return map_batches(work, _alike_in_cells(radii, similarity), "u binary, v binary")


def similar_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """(key, fingerprint, component_id) of each row, linking texts of this Jaccard similarity or more.

    As :func:`near_duplicates`, but fingerprints only propose: 512 bits over distinct shingles of five
    words, at a radius ``DEVIATIONS`` above what the similarity gives for texts of the size. Texts with a
    pair within the radius go once more through the chunks in which they have it, with their sets of shingles;
    there a link is made if the two sets have the similarity. Both times a task returns no pairs: first the
    texts concerned, then links that join what did not hang together in the chunk. So rows grow with the
    texts of a large group, not with its pairs. Texts with equal sets of shingles are one
    ``fingerprint``. Null and empty texts are alike. Null keys are allowed; keys should tell rows apart otherwise.
    """

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        made = [wide_fingerprint(t or b"", words) for t in texts]
        return {"fingerprint": pa.array([m[0] for m in made], pa.binary()), "size": pa.array([m[1] for m in made])}

    docs = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = map_blocks(docs, "text", run, "fingerprint binary, size bigint")
    prints = materialised(rows.withColumn("mark", F.xxhash64("text")).drop("text"))
    pick = F.min(F.struct(F.isnull("key").alias("none"), "key", "mark"))
    nodes = prints.groupBy("fingerprint").agg(
        F.min("key").alias("least"), F.min("size").alias("size"), pick.alias("pick")
    )
    nodes = materialised(nodes.withColumn("pick", F.struct("pick.key", "pick.mark")))
    # Sets below the size at which one may differ are alike only if equal, and then they are one node.
    asked = nodes.filter((F.col("size") + 1) * similarity <= F.col("size"))
    levels = range(ceil(log(_LARGE, SIZE_STEP)) + 2)
    radii = [wide_radius(similarity, ceil(SIZE_STEP ** (level - 1) - 1e-9), DEVIATIONS) for level in levels]
    flagged = materialised(_flagged(asked.select("fingerprint", "size"), radii))
    found = _shingle_links(docs, nodes, flagged, radii, words, similarity)
    return _grouped(prints, nodes, found, "key").withColumnRenamed("key", key)
