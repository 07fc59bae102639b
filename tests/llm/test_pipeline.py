"""The pipeline stage by stage, and all queries of the folder over the smallest tables."""

from __future__ import annotations

import pytest
from compare import differences, duckdb_tables
from fixtures import AWKWARD, prose, rows

import corpus_pipeline
from eventlake.llm import language, quality, simhash
from eventlake.llm.catalogue import ORACLE, QUERIES
from eventlake.llm.common import read

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, data, path):
    spark.createDataFrame(data, COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duckdb_tables(sf_dir), ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_every_row_has_a_result(spark, sf_dir, name):
    key = {"op1_mih": "query_id", "op10_urls": "page_id"}.get(name, "doc_id")
    found = sorted(r[key] for r in QUERIES[name](spark, sf_dir).select(key).collect())
    if name == "op1_mih":
        assert found == sorted(10 * [i for i in range(500) if i % 100 == 0])
    else:
        source = read(spark, sf_dir, "pages" if name == "op10_urls" else "documents")
        assert found == sorted(r[key] for r in source.select(key).collect())


def test_filters_keep_what_their_operators_accept(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    kept = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    accepted = quality.predict_quality(docs, labels).filter("predicted = 1").select("doc_id")
    assert kept.columns == docs.columns
    assert sorted(rows(kept.select("doc_id"))) == sorted(rows(accepted))
    kept = corpus_pipeline.language_stage(spark, docs, sf_dir)
    known = language.predict_languages(docs).filter("lang_pred <> 'und' and score >= 0.5").select("doc_id")
    assert sorted(rows(kept.select("doc_id"))) == sorted(rows(known))


def test_language_stage_rejects_what_no_learned_language_shortens(spark, tmp_path):
    learned = [(i, prose(i, 120), "en", "a", 1) for i in range(60)]
    short = [(100, "Z.", "en", "a", 1), (101, "AKIA9Q", "en", "a", 1), (102, prose(7, 60) + " password=9C82E4685CA7", "en", "a", 1)]
    noise = "".join(chr(0x21 + (i * i * 7 + i * 13) % 94) for i in range(2000))
    odd = [(200, "съешь ещё этих мягких французских булок " * 5, None, "a", 1), (201, "日本語のテキストです" * 10, None, "a", 1)]
    odd += [(202, noise, None, "a", 1)]
    docs = table(spark, learned + short + odd, str(tmp_path / "docs"))
    found = sorted(r[0] for r in rows(corpus_pipeline.language_stage(spark, docs, "")))
    assert found == [*range(60), 100, 101, 102]


def test_dedup_keeps_one_of_each_group(spark, tmp_path):
    words = prose(1, 400).split()
    near = " ".join(words[:200] + ["changed"] + words[201:])
    data = [(3, " ".join(words), "en", "a", 1), (2, near, "en", "a", 1), (9, prose(2, 300), "en", "a", 1)]
    data += [(9, prose(2, 300), "en", "a", 1), (None, prose(3, 200), None, None, None), (None, prose(4, 200), None, None, None)]
    data += [(None, near, None, None, None), (7, None, None, None, None), (8, "", None, None, None)]
    found = rows(corpus_pipeline.dedup_stage(spark, table(spark, data, str(tmp_path / "docs")), ""))
    assert sorted((str(r[0]), r[1]) for r in found) == sorted(
        [("2", near), ("9", prose(2, 300)), ("None", prose(3, 200)), ("None", prose(4, 200)), ("7", None)]
    )


def test_mixing_repeats_and_drops_documents(spark, tmp_path):
    data = [(i, prose(i, 50), "en", "a" if i < 80 else "b", 1) for i in range(100)]
    data += [(5, prose(5, 50), "en", "a", 1), (200, None, "en", "a", 0), (None, prose(7, 50), None, "b", 1)]
    docs = table(spark, data, str(tmp_path / "docs"))
    found = rows(corpus_pipeline.mixing_stage(spark, docs, ""))
    assert corpus_pipeline.mixing_stage(spark, docs, "").columns == docs.columns
    of_b = [r for r in found if r[3] == "b"]
    assert len(of_b) == 3 * 21
    assert abs(len(found) - 102) <= 1
    assert all(r[1] for r in found)


def test_stages_take_awkward_and_empty_tables(spark, sf_dir, tmp_path):
    for name, data in (("awkward", AWKWARD), ("empty", [])):
        docs = table(spark, data, str(tmp_path / name))
        for stage, function in corpus_pipeline.STAGES:
            found = function(spark, docs, sf_dir)
            assert found.count() <= 3 * len(data), stage


def test_run(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    found = result.collect()
    assert found and all(r["parity"] and r["round_trip"] for r in found)
    ids = {r["doc_id"] for r in found}
    groups = simhash.similar_texts(read(spark, sf_dir, "documents"))
    members = {}
    for key, _, group in rows(groups):
        members.setdefault(group, []).append(key)
    assert all(len(ids & set(keys)) <= 1 for keys in members.values() if len(keys) == 2)
