"""Folders of files with different schemas."""

import uuid
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from conftest import rows
from starmart.sources.crawl import SchemaConflictError, crawl, drift, footers, widest


@pytest.fixture
def database(spark, tmp_path):
    name = f"crawl_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _type(ddl):
    return T.DataType.fromDDL(ddl)


@pytest.mark.parametrize(
    "a, b, common",
    [
        ("tinyint", "bigint", "bigint"),
        ("int", "double", "double"),
        ("bigint", "double", None),
        ("smallint", "float", "double"),
        ("float", "double", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("bigint", "decimal(12,2)", "decimal(22,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"),
        ("decimal(38,0)", "decimal(38,20)", None),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("string", "int", None),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("array<int>", "array<string>", None),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int>", "struct<A:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("struct<a:int>", "struct<a:string>", None),
    ],
)
def test_widest(spark, a, b, common):
    assert widest(_type(a), _type(b)) == (common and _type(common))
    other = widest(_type(b), _type(a))
    assert (other and other.simpleString().lower()) == (common and common.lower())


def test_three_versions_are_one_table(spark, database, tmp_path):
    lake = tmp_path / "a lake's files"
    spark.sql("SELECT 1 AS id, CAST(7 AS INT) AS n, named_struct('x', 1) AS s").write.parquet(f"{lake}/v1")
    spark.sql("SELECT 2 AS id, 10000000000 AS n, named_struct('x', 5000000000, 'y', 'new') AS s").write.parquet(f"{lake}/v2")
    spark.sql("SELECT 3 AS id, CAST(1.25 AS DECIMAL(6,2)) AS n, 'late' AS extra").write.parquet(f"{lake}/v3")
    schema = crawl(spark, str(lake), f"{database}.t")
    assert schema.simpleString() == "struct<id:int,n:decimal(22,2),extra:string,s:struct<x:bigint,y:string>>"
    found = {r["id"]: r for r in spark.table(f"{database}.t").collect()}
    assert {i: r["n"] for i, r in found.items()} == {1: Decimal(7), 2: Decimal(10**10), 3: Decimal("1.25")}
    assert {i: r["extra"] for i, r in found.items()} == {1: None, 2: None, 3: "late"}
    assert [found[i]["s"] and tuple(found[i]["s"]) for i in (1, 2, 3)] == [(1, None), (5_000_000_000, "new"), None]
    report = drift(spark, str(lake)).where("column_name IN ('n', 'extra')")
    assert rows(report) == sorted(
        [
            ("n", "int", 1, 1, "decimal(22,2)", 0),
            ("n", "bigint", 1, 1, "decimal(22,2)", 0),
            ("n", "decimal(6,2)", 1, 1, "decimal(22,2)", 0),
            ("extra", "string", 1, 1, "string", 2),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_conflicts_are_named_or_left_out(spark, database, tmp_path):
    spark.sql("SELECT 1 AS id, 'a' AS v").write.parquet(f"{tmp_path}/lake/v1")
    spark.sql("SELECT 2 AS id, 5 AS v").write.parquet(f"{tmp_path}/lake/v2")
    with pytest.raises(SchemaConflictError, match="of v in"):
        crawl(spark, f"{tmp_path}/lake", f"{database}.t")
    crawl(spark, f"{tmp_path}/lake", f"{database}.t", omit_conflicts=True)
    assert rows(spark.table(f"{database}.t")) == [(1,), (2,)]
    assert {r["common_type"] for r in drift(spark, f"{tmp_path}/lake").where("column_name = 'v'").collect()} == {None}


def test_files_of_other_writers_and_a_second_crawl(spark, database, tmp_path):
    lake = tmp_path / "lake"
    lake.mkdir()
    pq.write_table(pa.table({"Id": pa.array([1], pa.int32())}), lake / "a.parquet")
    name = f"{database}.t"
    assert crawl(spark, str(lake), name).simpleString() == "struct<Id:int>"
    pq.write_table(pa.table({"id": pa.array([1 << 40], pa.int64()), "u": pa.array([1], pa.uint64())}), lake / "b.parquet")
    assert {(r["type"], r["common_type"]) for r in drift(spark, str(lake)).where("column_name = 'u'").collect()} == {("unknown uint64", None)}
    assert crawl(spark, str(lake), name, replace=True, omit_conflicts=True).simpleString() == "struct<Id:bigint>"
    assert rows(spark.table(name)) == [(1,), (1 << 40,)]
    # The files outlive the declaration.
    assert footers(spark, str(lake)).select("path").distinct().count() == 2


def test_empty_folder_and_empty_files(spark, database, tmp_path):
    (tmp_path / "none").mkdir()
    assert drift(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError, match="no columns"):
        crawl(spark, f"{tmp_path}/none", f"{database}.t")
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    assert [(r["column_name"], r["rows"]) for r in drift(spark, f"{tmp_path}/empty").collect()] == [("id", 0)]
