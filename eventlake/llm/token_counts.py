"""Token counts under a unigram vocabulary, by forward scores shared along a trie."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventlake.llm.common import Shipped, byte_blocks, map_batches, refuse_clash
from eventlake.llm.grams import Lookup
from eventlake.llm.pieces import MARKER, MODEL_PATH, NORMAL, PieceModel

#: Pre-tokens up to so many bytes share a trie; longer ones, which are rare, are scored alone.
TRIE_BYTES = 64
#: Distinct pre-tokens that a task remembers before it starts afresh.
REMEMBERED = 1 << 18
#: An unknown character scores so much less than the worst piece.
UNKNOWN_PENALTY = 10.0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = -np.inf


def _length(first: int) -> int:
    """Bytes of the UTF-8 character that begins with this byte."""
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class TokenCounter:
    """Numbers of tokens on the best path, where pieces add their scores.

    Of equally good paths the one whose last piece is longest counts, as in
    sentencepiece. A character that no piece of its own covers may be taken as its bytes, at the
    worst piece's score less ``UNKNOWN_PENALTY``.
    """

    def __init__(self, model: PieceModel):
        if not model.splits:
            raise ValueError("pieces of this model cross spaces")
        scores = [(p.replace(MARKER, " ").encode(), s) for p, s, kind in model.pieces if kind == NORMAL]
        self.pieces = {}
        for piece, score in scores:
            self.pieces[piece] = max(score, self.pieces.get(piece, _NONE))
        self.unknown = min(self.pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces), default=1)
        self.powers = np.full(self.longest + 1, _BASE, np.uint64)
        self.powers[0] = 1
        self.powers = np.cumprod(self.powers)
        self.levels = [None]
        for length in range(1, self.longest + 1):
            ends = sorted({p[-length:] for p in self.pieces if len(p) >= length})
            codes = np.array([self._hash(e) for e in ends], np.uint64)
            values = np.array([self.pieces.get(e, _NONE) for e in ends])
            self.levels.append((Lookup(codes), values))
        self.known: dict[bytes, int] = {}

    def _hash(self, data: bytes) -> int:
        code = 0
        for x in data:
            code = (code * int(_BASE) + x + 1) % 2**64
        return code

    def alone(self, token: bytes) -> int:
        """The count of one pre-token, position by position."""
        best, count = [0.0] + [_NONE] * len(token), [0] * (len(token) + 1)
        for start in range(len(token)):
            if token[start] & 0xC0 == 0x80 or best[start] == _NONE:
                continue
            size = _length(token[start])
            for end in range(start + 1, min(len(token), start + self.longest) + 1):
                score = self.pieces.get(token[start:end])
                if score is not None and best[start] + score > best[end]:
                    best[end], count[end] = best[start] + score, count[start] + 1
            end = start + size
            if token[start:end] not in self.pieces and best[start] + self.unknown > best[end]:
                best[end], count[end] = best[start] + self.unknown, count[start] + size
        return count[-1]

    def trie(self, tokens: list[bytes]) -> np.ndarray:
        """Counts of sorted distinct pre-tokens of at most ``TRIE_BYTES``.

        A node is a prefix; its forward score and count are worked out once for all
        pre-tokens below it, a whole depth at a time. Only suffixes of pieces are followed back.
        """
        sizes = np.array([len(t) for t in tokens])
        table = np.zeros((len(tokens), int(sizes.max())), np.int16)
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        row = np.repeat(np.arange(len(tokens)), sizes)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        table[row, column] = flat.astype(np.int16) + 1
        differs = table[1:] != table[:-1]
        shared = np.concatenate(([0], np.where(differs.any(axis=1), differs.argmax(axis=1), table.shape[1])))
        node = np.zeros(len(tokens), np.int64)
        parents, hashes, best, counts = [None], [np.zeros(1, np.uint64)], [np.zeros(1)], [np.zeros(1, np.int64)]
        starts = [np.zeros(1, bool)]  # whether the node's last byte goes on a character
        result = np.zeros(len(tokens), np.int64)
        for depth in range(1, table.shape[1] + 1):
            rows = np.flatnonzero(sizes >= depth)
            fresh = shared[rows] < depth
            fresh[0] = True
            first = rows[fresh]
            parent, byte = node[first], table[first, depth - 1]
            node[rows] = np.cumsum(fresh) - 1
            code = hashes[-1][parent] * _BASE + byte.astype(np.uint64)
            parents.append(parent)
            hashes.append(code)
            starts.append((byte - 1) & 0xC0 == 0x80)
            score, count = np.full(len(first), _NONE), np.zeros(len(first), np.int64)
            self._forward(depth, parents, hashes, starts, best, counts, score, count, table[first])
            best.append(score)
            counts.append(count)
            ended = rows[sizes[rows] == depth]
            result[ended] = count[node[ended]]
        return result

    def _forward(self, depth, parents, hashes, starts, best, counts, score, count, prefix) -> None:
        at, above = np.arange(len(score)), np.arange(len(score))
        whole = np.zeros(len(score), bool)
        for length in range(1, min(depth, self.longest) + 1):
            above = parents[depth - length + 1][above]
            code = hashes[depth][at] - hashes[depth - length][above] * self.powers[length]
            lookup, values = self.levels[length]
            place = lookup.find(code)
            # A character's own start: an unknown one can be taken as bytes from here.
            opens = ~whole[at]
            lead = prefix[at, depth - length] - 1
            size = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            own = opens & (lead & 0xC0 != 0x80) & (size == length)
            value = np.where(place >= 0, values[place], _NONE)
            self._better(best, counts, score, count, depth - length, at, above, value, 1)
            odd = own & (value == _NONE)
            if odd.any():
                unknown = np.full(int(odd.sum()), self.unknown)
                self._better(best, counts, score, count, depth - length, at[odd], above[odd], unknown, length)
            keep = (place >= 0) | (opens & (lead & 0xC0 == 0x80))
            whole[at[own]] = True
            at, above = at[keep], above[keep]
            if not len(at):
                break

    @staticmethod
    def _better(best, counts, score, count, depth, at, above, value, tokens) -> None:
        total = best[depth][above] + value
        # Longer last pieces come later, and win ties.
        take = (total >= score[at]) & (total > _NONE)
        score[at[take]] = total[take]
        count[at[take]] = counts[depth][above[take]] + tokens

    def count(self, texts: list[list[bytes]]) -> np.ndarray:
        """Token counts of texts given as their pre-tokens."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = sorted({p for parts in texts for p in parts if p not in known})
        short = [p for p in new if len(p) <= TRIE_BYTES]
        if short:
            known.update(zip(short, self.trie(short).tolist()))
        known.update((p, self.alone(p)) for p in new if len(p) > TRIE_BYTES)
        return np.array([sum(map(known.__getitem__, parts)) for parts in texts], np.int64)


def count_tokens(docs: DataFrame, text: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """All columns of ``docs`` but the text, ``n_pretokens`` and ``n_tokens`` of the whole text.

    The piece scores of the model file serve as unigram scores. Null and empty texts have none,
    long ones are counted whole, repeated rows each for itself. Other columns stay; ``docs`` must not have columns of these two
    names.
    """
    shared = Shipped(docs.sparkSession, PieceModel.load(model_path))
    keep = [name for name in docs.columns if name != text]
    refuse_clash(keep, ["n_pretokens", "n_tokens"])
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        counter = TokenCounter(model)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for block in byte_blocks(batch, at):
                cut = [[p.encode() for p in model.parts(t)] if t else [] for t in block.column(at).to_pylist()]
                sizes = pa.array([len(parts) for parts in cut], pa.int64())
                columns = [block.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, sizes, pa.array(counter.count(cut))], names=[*keep, "n_pretokens", "n_tokens"]
                )

    return map_batches(docs, run, ", ".join([*schema, "n_pretokens bigint", "n_tokens bigint"]))
