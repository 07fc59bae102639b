"""Stages whose input is cut into other partitions before they are carried out."""

from __future__ import annotations

import pytest
from fixtures import prose, rows

import corpus_pipeline

PACKED = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}


@pytest.mark.parametrize("stage", [corpus_pipeline.dedup_stage, corpus_pipeline.mixing_stage])
def test_rows_keep_their_numbers(spark, tmp_path, stage):
    data = [(i, prose(i, 60), "en", "a", 1) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(6).write.parquet(str(tmp_path / "docs"))
    kept = stage(spark, spark.read.parquet(str(tmp_path / "docs")), "")
    for name, value in PACKED.items():
        spark.conf.set(name, value)
    try:
        found = sorted(r[0] for r in rows(kept))
    finally:
        for name in PACKED:
            spark.conf.unset(name)
    assert found == list(range(60))
