"""Encoding and counting against sentencepiece, and the trie against single tokens."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
import sentencepiece
from fixtures import AWKWARD, documents, prose, rows
from sentencepiece import sentencepiece_model_pb2

from eventlake.llm import sentencepieces, token_counts
from eventlake.llm.pieces import MODEL_PATH, PieceModel

MODEL = PieceModel.load(MODEL_PATH)
TEXTS = [prose(i, 80, "abcdefghéß") for i in range(30)]
TEXTS += ["", " ", "  a   b ", "日本語 😀x", "<s> hi </s> <0x0A>", "a▁b", " \n\n\tfoo", "\x00 z", "x" * 3000]


@pytest.fixture(scope="module")
def unigram():
    """The same pieces read as a unigram model, with scores of moderate size."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(Path(MODEL_PATH).read_bytes())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = piece.score / 1000 if piece.score > -1e8 else -100
    return PieceModel(proto.SerializeToString())


def test_encoding_is_the_original(spark):
    table = documents(spark, [(i, t, None, None, None) for i, t in enumerate(TEXTS)]).select("doc_id", "text")
    encoded = sentencepieces.encode(table)
    original = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    found = {r["doc_id"]: r for r in encoded.collect()}
    for i, text in enumerate(TEXTS):
        assert found[i]["ids"] == original.encode(text)
        assert found[i]["n_tokens"] == len(found[i]["ids"])
        assert found[i]["parity"]
        assert found[i]["round_trip"]
    decoded = {r["doc_id"]: r["decoded"] for r in sentencepieces.decode(encoded).collect()}
    assert [decoded[i] for i in range(len(TEXTS))] == [t.replace("▁", " ") for t in TEXTS]


def test_unigram_models_encode_too(unigram):
    encoder = sentencepieces.Encoder(unigram)
    ids, same, back = encoder(TEXTS[:30])
    assert same.mean() > 0.8 and back.all()
    assert [len(x) > 0 for x in ids.to_pylist()] == [True] * 30


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 10)
    monkeypatch.setattr(sentencepieces, "LINE_PARTS", 3)
    encoder, again = sentencepieces.Encoder(MODEL), sentencepieces.Encoder(MODEL)
    parts = [x for t in TEXTS for x in encoder([t])[0].to_pylist()]
    assert parts == again(TEXTS)[0].to_pylist()


def test_trie_counts_as_single_tokens():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab éж日😀▁中qz", k=rng.randint(1, 40))) for _ in range(800)]
    counter = token_counts.TokenCounter(MODEL)
    parts = sorted({p.encode() for t in texts for p in MODEL.parts(t)})
    short = [p for p in parts if len(p) <= token_counts.TRIE_BYTES]
    assert counter.trie(short).tolist() == [counter.alone(p) for p in short]


def test_counts_are_those_of_unigram_models(unigram):
    original = sentencepiece.SentencePieceProcessor(model_proto=unigram.raw)
    counter = token_counts.TokenCounter(unigram)
    texts = [prose(i, 60) for i in range(40)]
    found = counter.count([[p.encode() for p in unigram.parts(t)] for t in texts]).tolist()
    expected = [len(original.encode(t)) for t in texts]
    # Its single-precision sums decide a few near-ties differently.
    assert sum(a == b for a, b in zip(found, expected)) >= 38
    assert all(abs(a - b) <= 1 for a, b in zip(found, expected))


def test_awkward_and_empty(spark):
    table = documents(spark).drop("score", "size")
    found = rows(token_counts.count_tokens(table))
    assert len(found) == len(AWKWARD)
    assert {r[-2:] for r in found if r[0] in (1, 2)} == {(0, 0)}
    encoded = sentencepieces.encode(table).collect()
    assert len(encoded) == len(AWKWARD) and all(r["parity"] and r["round_trip"] for r in encoded)
    empty = documents(spark, []).drop("score", "size")
    assert rows(token_counts.count_tokens(empty)) == rows(sentencepieces.encode(empty)) == []


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="already"):
        sentencepieces.encode(documents(spark).withColumnRenamed("size", "ids"))
    with pytest.raises(ValueError, match="already"):
        token_counts.count_tokens(documents(spark).withColumnRenamed("size", "n_tokens"))
