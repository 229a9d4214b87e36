"""Operators leave nothing behind: no checkpoint, workspace or table, also after the session was stopped."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT

SF = "/root/testdata/sf0.001"

RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import corpus_pipeline
from starmart.llm.queries import QUERIES
spark = (
    SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.warehouse.dir", sys.argv[3])
    .config("spark.executorEnv.PYTHONPATH", sys.argv[1]).getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
for query in (*QUERIES.values(), corpus_pipeline.run):
    query(spark, sys.argv[4])
print("tables", [t.name for t in spark.catalog.listTables() if not t.isTemporary])
stages = [d for d, _, names in __import__("os").walk(sys.argv[5]) if names and d.rsplit("/")[-1] in dict(corpus_pipeline.STAGES)]
print("stages", [d.rsplit("/")[-1] for d in stages])
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_nothing_stays(tmp_path):
    shared, warehouse = tmp_path / "shared", tmp_path / "warehouse"
    shared.mkdir()
    warehouse.mkdir()
    command = [sys.executable, "-c", RUN, ROOT, f"file://{shared}", str(warehouse), SF, str(shared)]
    done = subprocess.run(command, capture_output=True, text=True, timeout=900, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2_000:]
    assert "tables []" in done.stdout
    # While the session ran, of the pipeline's stages only the last was kept.
    assert "stages ['bpe']" in done.stdout
    assert [f for top in (shared, warehouse) for _, _, names in os.walk(top) for f in names] == []
