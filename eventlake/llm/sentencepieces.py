"""SentencePiece encoding and decoding by the tokenizers library, checked against the original."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from eventlake.llm.common import Shipped, byte_blocks, map_batches, refuse_clash
from eventlake.llm.pieces import BPE, MARKER, MODEL_PATH, NORMAL, UNKNOWN, PieceModel

#: Distinct parts that a task remembers before it starts afresh.
REMEMBERED = 1 << 18
#: Parts in a line that is encoded at once.
LINE_PARTS = 128
_LEAD = "a"


def merges(model: PieceModel) -> list[tuple[str, str]]:
    """Every way to make a piece from two others, the best pieces first."""
    number = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    found = []
    for piece, i in number.items():
        for cut in range(1, len(piece)):
            left, right = number.get(piece[:cut]), number.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-model.pieces[i][1], i, left, right))
    return [(model.pieces[a][0], model.pieces[b][0]) for _, _, a, b in sorted(found)]


def rebuild(model: PieceModel) -> Tokenizer:
    """The model as a tokenizer of the tokenizers library.

    Unigram models keep their scores, BPE models their order as merges; both fall back to
    bytes if the file says so. The normaliser's steps and the marker in front are the file's.
    """
    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == BPE:
        vocab = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
        inner = models.BPE(
            vocab,
            merges(model),
            unk_token=model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        scores = [(piece, score) for piece, score, _ in model.pieces]
        inner = models.Unigram(scores, unknown, byte_fallback=model.byte_fallback)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.tidy:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.prefix:
        steps.append(normalizers.Prepend(" "))
    tokenizer = Tokenizer(inner)
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    strip = [decoders.Strip(" ", 1, 0)] if model.prefix else []
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *strip]
    )
    return tokenizer


class Encoder:
    """Ids of texts, each distinct part encoded, decoded and checked once.

    Where the model's pieces allow no cut, a text is one part. Parts with a single space
    are encoded many to a line: only their first id begins with a marker, so the line's ids are cut there.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.tokenizer = rebuild(model)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=model.raw)
        self.marks = np.array([piece.startswith(MARKER) for piece, _, _ in model.pieces])
        self.lead = len(self.original.encode(_LEAD))
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)
        self.same = np.zeros(0, bool)
        self.back = np.zeros(0, bool)

    def parts(self, text: str | None) -> list[str]:
        if not text:
            return []
        return self.model.parts(text) if self.model.splits else [text]

    def plain(self, part: str) -> str:
        """The text that stands for a part: both encoders put the first marker in themselves.

        A lone space ends a text and has no text of its own; it stands behind a letter.
        """
        return part if not self.model.splits else part[1:] or _LEAD + part

    def batch(self, lines: list[str]) -> tuple[list[list[int]], list[bool], list[bool]]:
        """Ids of the lines from one multithreaded batch, whether they are the original's and decode back."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        expected = self.original.encode(lines, num_threads=1)
        wanted = lines if self.model.splits else self.original.decode(expected)
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return ids, [a == b for a, b in zip(ids, expected)], [a == b for a, b in zip(decoded, wanted)]

    def learn(self, new: list[str]) -> None:
        single = [p for p in new if self.model.splits and p[1:2] not in ("", " ")]
        joined = [single[i : i + LINE_PARTS] for i in range(0, len(single), LINE_PARTS)]
        alone = [p for p in new if not self.model.splits or p[1:2] in ("", " ")]
        found: list[tuple[list[str], np.ndarray, np.ndarray]] = []
        for parts, ids, same, back in zip(joined, *self.batch(["".join(x)[1:] for x in joined])):
            starts = np.flatnonzero(self.marks[ids])
            if same and back and len(starts) == len(parts):
                found.append((parts, np.array(ids, np.int32), np.diff(starts, append=len(ids))))
            else:
                alone += parts
        flags = np.ones(sum(len(parts) for parts, _, _ in found), bool)
        ids, same, back = self.batch([self.plain(p) for p in alone])
        ids = [row if p != " " or not self.model.splits else row[self.lead :] for p, row in zip(alone, ids)]
        found.append((alone, np.array([x for row in ids for x in row], np.int32), np.array([len(r) for r in ids], np.int64)))
        for parts, _, _ in found:
            self.place.update(zip(parts, range(len(self.place), len(self.place) + len(parts))))
        self.ids = np.concatenate([self.ids, *(ids for _, ids, _ in found)])
        self.sizes = np.concatenate([self.sizes, *(sizes for _, _, sizes in found)])
        self.same = np.concatenate([self.same, flags, np.array(same, bool)])
        self.back = np.concatenate([self.back, flags, np.array(back, bool)])

    def __call__(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Ids of each text, whether they are the original's, and whether they decode to the text."""
        if len(self.place) > REMEMBERED:
            self.forget()
        cut = [self.parts(text) for text in texts]
        flat = [p for parts in cut for p in parts]
        new = [p for p in dict.fromkeys(flat) if p not in self.place]
        if new:
            self.learn(new)
        rows = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        edges = np.cumsum([0, *map(len, cut)])
        sizes = self.sizes[rows]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        begins = (np.cumsum(self.sizes) - self.sizes)[rows]
        ids = self.ids[np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])]
        lists = pa.ListArray.from_arrays(pa.array(ends[edges], pa.int32()), pa.array(ids, pa.int32()))
        bad = [np.concatenate(([0], np.cumsum(~flag[rows])))[edges] for flag in (self.same, self.back)]
        return lists, np.diff(bad[0]) == 0, np.diff(bad[1]) == 0


def encode(docs: DataFrame, text: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """All columns of ``docs`` but the text, and ``ids``, ``n_tokens``, ``parity``, ``round_trip``.

    ``parity`` says whether sentencepiece itself gives the same ids, ``round_trip`` whether they
    decode to the text (a marker that stands in the text comes back as a space). Both are
    checked for every text, on its distinct parts. Null and empty texts have no ids, long
    ones are encoded whole, repeated rows each for itself. Other columns stay; ``docs`` must not have columns of these four
    names.
    """
    shared = Shipped(docs.sparkSession, PieceModel.load(model_path))
    keep = [name for name in docs.columns if name != text]
    refuse_clash(keep, ["ids", "n_tokens", "parity", "round_trip"])
    names = [*keep, "ids", "n_tokens", "parity", "round_trip"]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
    schema += ["ids array<int>", "n_tokens int", "parity boolean", "round_trip boolean"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for block in byte_blocks(batch, at):
                ids, parity, returned = encoder(block.column(at).to_pylist())
                counts = pa.array(np.diff(ids.offsets.to_numpy()), pa.int32())
                columns = [block.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, ids, counts, pa.array(parity), pa.array(returned)], names=names
                )

    return map_batches(docs, run, ", ".join(schema))


def decode(encoded: DataFrame, ids: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the text of its ids; null ids give null."""
    shared = Shipped(encoded.sparkSession, PieceModel.load(model_path))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema), "decoded string"])
    names = [*encoded.columns, "decoded"]
    refuse_clash(encoded.columns, ["decoded"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = rebuild(shared.value)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = iter(tokenizer.decode_batch([x for x in lists if x is not None], skip_special_tokens=False))
            decoded = pa.array([None if x is None else next(texts) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=names)

    return map_batches(encoded, run, schema)
