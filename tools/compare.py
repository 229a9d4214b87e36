"""Run queries on Spark and their SQL on DuckDB; compare types and rows.

    python tools/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.queries import ORACLE, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(t: pa.DataType) -> str:
    text = str(t).replace("large_", "").replace("decimal128", "decimal")
    return "string" if text in ("string", "string_view") else text


def _rows(data: pa.Table) -> list[tuple]:
    names = sorted(data.column_names)
    rows = zip(*[data.column(n).to_pylist() for n in names], strict=True) if names else []
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got = spark_df.toArrow()
    want = con.sql(sql).to_arrow_table()
    found = []
    types = [{n: _plain(t.schema.field(n).type) for n in t.column_names} for t in (got, want)]
    if types[0] != types[1]:
        names = sorted(types[0].keys() | types[1].keys())
        found += [
            f"{n}: {types[0].get(n)} vs {types[1].get(n)}"
            for n in names
            if types[0].get(n) != types[1].get(n)
        ]
    if got.num_rows != want.num_rows:
        found.append(f"rows: {got.num_rows} vs {want.num_rows}")
    if sorted(got.column_names) == sorted(want.column_names):
        a, b = _rows(got), _rows(want)
        unequal = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
        if unequal:
            found.append(f"{len(unequal)} rows differ, first: {unequal[0]}")
    return found


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, failed = session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            found = differences(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{len(names) - failed}/{len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
