"""A SentencePiece model file: its pieces, and texts cut where no piece can cross."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

from sentencepiece import sentencepiece_model_pb2

#: Marks a space inside pieces.
MARKER = "▁"
#: Where the public tokenizer files are installed; a parameter of every operator that uses one.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
_PARTS = re.compile(" +[^ ]*")


@dataclass
class PieceModel:
    """What the encoder needs of the protobuf; ``raw`` is the whole file."""

    raw: bytes
    kind: int = field(init=False)
    pieces: list[tuple[str, float, int]] = field(init=False, repr=False)

    def __post_init__(self):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.raw)
        normal = proto.normalizer_spec
        self.kind = proto.trainer_spec.model_type
        self.pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.charsmap = normal.precompiled_charsmap
        self.prefix = normal.add_dummy_prefix
        self.tidy = normal.remove_extra_whitespaces
        if self.kind not in (UNIGRAM, BPE) or not normal.escape_whitespaces:
            raise ValueError("only unigram and BPE models with a space marker are supported")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(t == USER_DEFINED for _, _, t in self.pieces):
            raise ValueError("suffix markers and user-defined pieces are not supported")
        crossing = (p.lstrip(MARKER) for p, _, t in self.pieces if t == NORMAL)
        #: Pieces hold markers only in front, so texts can be cut before each run of spaces.
        self.splits = self.prefix and not self.tidy and not self.charsmap and not any(MARKER in p for p in crossing)

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """Read on the driver; tasks get the bytes, a file of some MB at most."""
        return cls(Path(path).read_bytes())

    def parts(self, text: str) -> list[str]:
        """The marked text in parts that are encoded independently; spaces stand for markers.

        Every part begins with a space. An empty text has no parts.
        """
        return _PARTS.findall(" " + text.replace(MARKER, " ")) if text else []
