"""Workers that cannot import the package run every operator."""

from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT, SF_DIR

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "shared").getOrCreate()
)
def importable(batches):
    import importlib.util, pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("eventlake") is not None]}})
assert not any(r["found"] for r in spark.range(1).mapInArrow(importable, "found boolean").collect())
from eventlake.llm.catalogue import QUERIES
import corpus_pipeline
for name, run in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    run(spark, {sf!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=str(ROOT), sf=SF_DIR)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14
