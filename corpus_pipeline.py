"""From ``documents`` to encoded training text, one written table per stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm import language, mixing, quality, sentencepieces, simhash
from eventlake.llm.common import materialised, read, remainder, shared_folder

#: A document stays if its language is known with this score at least.
LANGUAGE_SCORE = 0.5
#: A text is in no known language if eight bits a byte, which need no model, are shorter by more bits than these.
UNFIT_BITS = 64
#: Stands before a stage's input columns, so that what it adds clashes with none.
_MARK = "in_"


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.col(f"`{name}`").alias(_MARK + name) for name in docs.columns))


def _unmarked(marked: DataFrame) -> list:
    return [F.col(f"`{n}`").alias(n[len(_MARK) :]) for n in marked.columns if n.startswith(_MARK)]


def _numbered(docs: DataFrame) -> DataFrame:
    """Marked columns and ``row``, written once: two scans of a table can cut it up differently."""
    return materialised(_marked(docs).withColumn("row", F.monotonically_increasing_id()))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from these and ``labels``.

    Null and empty texts get a score like any other, long ones are read whole, repeated rows are judged alike;
    without labels nothing is learned and all stay.
    """
    scorer = quality.learn(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(_marked(docs), scorer, _MARK + "text")
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*_unmarked(scored))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters, the undecided and those that no language's model shortens go.

    The last are texts in scripts that no learned language has, and noise; ``UNFIT_BITS`` spares short ones.

    Null and empty texts have no letters, so they go, as all do where no language can be learned; long texts are read
    whole, repeated rows judged alike.
    """
    languages, model = language.learn(docs.filter(remainder("doc_id", 3) != 1))
    found = language.identify(_marked(docs), languages, model, _MARK + "text")
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LANGUAGE_SCORE)
    size = F.octet_length(_MARK + "text")
    fits = F.col("bits_per_byte") * size <= 8 * size + UNFIT_BITS
    return found.filter(known & fits).select(*_unmarked(found))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a Jaccard similarity of 0.8 in five-word shingles: the smallest doc_id, null last.

    Rows are told apart by number, so repeated ids and null ids are documents like any other.
    """
    rows = _numbered(docs)
    key = F.struct(F.isnull(_MARK + "doc_id").alias("none"), F.col(_MARK + "doc_id").alias("id"), "row")
    groups = simhash.similar_texts(rows.select(key.alias("key"), F.col(_MARK + "text").alias("text")), "key")
    stay = groups.filter(F.col("key") == F.col("component_id")).select(F.col("key.row").alias("row"))
    return rows.join(stay, "row", "left_semi").select(*_unmarked(rows))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole number; without words never.

    So null and empty texts go. A null source is one like any other; repeated rows are taken each for itself.
    """
    rows = _numbered(docs)
    plain = {_MARK + "text": "text", _MARK + "source": "source", _MARK + "doc_id": "id", "row": "row"}
    named = rows.select(*(F.col(old).alias(new) for old, new in plain.items()))
    taken = mixing.mixture(named, "row", shuffle="id").filter("taken > 0")
    copies = taken.select("row", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies"))
    kept = rows.join(copies.filter("copies > 0"), "row")
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*_unmarked(rows))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, parity, round_trip) of every document.

    Null and empty texts have no ids; long texts are encoded whole, repeated rows each for itself.
    """
    return sentencepieces.encode(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near-duplicates", dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: SQL cannot express the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
