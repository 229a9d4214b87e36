import os
import uuid

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from listing_rows import raw_rows
from starmart.operators.checks import schema_issues
from starmart.plans.listings import LISTINGS_STAR, RAW_SCHEMA, load_listings
from starmart.sources import catalog
from starmart.sources.delimited import load_delimited, read_csv, write_csv
from starmart.sources.store import FolderStore, TableStore, shared_dir, workspace
from starmart.spec import columns, struct_of


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, str(tmp_path / "warehouse"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_csv_round_trip_of_raw_listings(spark, tmp_path):
    """Commas, quotes, newlines and NULLs survive."""
    raw = raw_rows(spark)
    write_csv(raw, str(tmp_path / "csv"))
    assert rows(read_csv(spark, str(tmp_path / "csv"), RAW_SCHEMA)) == rows(raw)


def test_empty_text_and_null(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "i int, t string")
    write_csv(df, str(tmp_path / "csv"))
    path = str(tmp_path / "csv")
    assert rows(read_csv(spark, path, df.schema)) == [(1, None), (2, None), (3, "x")]
    assert rows(read_csv(spark, path, df.schema, keep_empty=True)) == rows(df)


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;price;name\n1;2.5;"x;\ny"\n')
    df = read_csv(spark, str(tmp_path / "a.csv"), sep=";")
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string"]
    assert rows(df) == [(1, 2.5, "x;\ny")]


def test_load_sets_bad_lines_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,day,name\n1,2023-01-02,"a\nb"\nx,2023-01-02,c\n3,never,d\n')
    schema = struct_of(columns("id bigint, day date, name string"))
    good, bad = load_delimited(
        spark, str(tmp_path / "a.csv"), schema, "t", FolderStore(str(tmp_path / "out"))
    )
    assert [(r.id, str(r.day), r.name) for r in good.collect()] == [(1, "2023-01-02", "a\nb")]
    assert rows(bad) == [("3,never,d",), ("x,2023-01-02,c",)]


def test_databases(spark, database):
    assert database in catalog.list_databases(spark)
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, database)
    assert spark.catalog.currentDatabase() == database
    catalog.use_database(spark, before)


def test_star_in_declared_tables(spark, database):
    names = catalog.create_star_tables(spark, LISTINGS_STAR, database)
    assert len(names) == 10
    catalog.create_star_tables(spark, LISTINGS_STAR, database)  # present tables stay
    tables = load_listings(raw_rows(spark), TableStore(database))
    for name in LISTINGS_STAR.write_order:
        read = catalog.scan_table(spark, name, database)
        assert schema_issues(read.schema, LISTINGS_STAR.table_schema(name)) == []
        assert rows(read) == rows(tables[name])
    again = load_listings(raw_rows(spark), TableStore(database))  # a load replaces the last one
    assert again["listings"].count() == raw_rows(spark).count()


def test_declared_widths_are_enforced(spark, database):
    catalog.create_star_tables(spark, LISTINGS_STAR, database, widths=True)
    with pytest.raises(PySparkException, match="(?i)length|exceed"):
        load_listings(raw_rows(spark), TableStore(database))


def test_register_folder(spark, database, tmp_path):
    for name in ("dim_a", "dim_b", "fact"):
        spark.range(3).write.parquet(str(tmp_path / "lake" / name))
    found = catalog.register_folder(spark, str(tmp_path / "lake"), database, "dim%")
    assert found == [f"{database}.dim_a", f"{database}.dim_b"]
    assert spark.table(found[0]).count() == 3


def test_table_store_refuses_other_columns(spark, database):
    store = TableStore(database)
    store.save("t", spark.range(2))
    with pytest.raises(ValueError):
        store.save("t", spark.range(2).toDF("other"))


def test_peek(spark):
    assert rows(catalog.peek(spark.range(10), 2, "id")) == [(0,), (1,)]


def test_load_leaves_nothing_in_the_shared_folder(spark, tmp_path):
    folder = os.path.join(shared_dir(spark).removeprefix("file:"), "starmart")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for kind in ("hash", "dense", "monotonic"):
        load_listings(raw_rows(spark), FolderStore(str(tmp_path / kind)), key_kind=kind)
    assert set(os.listdir(folder)) == before


def test_workspace_is_in_the_shared_folder(spark):
    store = workspace(spark)
    assert store.base.startswith(shared_dir(spark).rstrip("/"))
    assert store.base != workspace(spark).base
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert os.path.isabs(shared_dir(spark).removeprefix("file:"))
