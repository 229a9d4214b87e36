"""Nothing is left behind: every query in a process of its own, stopped the usual way."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT

SF = "/root/testdata/sf0.001"

RUN_ALL = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from starmart.queries import QUERIES
spark = (
    SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.warehouse.dir", sys.argv[3]).getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
for name, query in QUERIES.items():
    query(spark, sys.argv[4])
print("databases", [d.name for d in spark.catalog.listDatabases()])
print("tables", [t.name for t in spark.catalog.listTables() if not t.isTemporary])
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_no_folder_table_or_database_stays(tmp_path):
    shared, warehouse = tmp_path / "shared", tmp_path / "warehouse"
    shared.mkdir()
    warehouse.mkdir()
    command = [sys.executable, "-c", RUN_ALL, ROOT, f"file://{shared}", str(warehouse), SF]
    done = subprocess.run(command, capture_output=True, text=True, timeout=900, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2_000:]
    assert "databases ['default']" in done.stdout and "tables []" in done.stdout
    left = [os.path.join(d, f) for top in (shared, warehouse) for d, _, names in os.walk(top) for f in names]
    assert left == []
    assert sorted(os.listdir(tmp_path)) == ["shared", "warehouse"]
