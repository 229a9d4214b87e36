"""Sources, sinks, catalog. Files go to the session's shared folder."""

from __future__ import annotations

import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.profile import row_counts
from starmart.plans.orders import ORDERS_STAR
from starmart.plans.star import build_star, denormalize
from starmart.queries.inputs import MESSY_SQL, WIDE_SQL, messy, table, wide
from starmart.queries.registry import query
from starmart.sources import catalog
from starmart.sources.crawl import crawl, drift
from starmart.sources.delimited import load_delimited, read_csv, write_csv
from starmart.sources.store import FolderStore, TableStore, workspace
from starmart.sources.versions import Versions
from starmart.spec import columns, struct_of


def _database(spark: SparkSession) -> str:
    """A new database whose tables lie in the shared folder."""
    name = f"starmart_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, workspace(spark).base)
    return name


def _finished(df: DataFrame, database: str) -> DataFrame:
    """The rows of ``df``, written, and the database it reads from dropped: a lasting catalog keeps nothing."""
    saved = workspace(df.sparkSession).save("rows", df)
    df.sparkSession.sql(f"DROP DATABASE {database} CASCADE")
    return saved


@query(MESSY_SQL)
def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas, NULLs and empty texts survive writing and reading CSV."""
    rows = messy(spark, sf_dir)
    path = workspace(spark).path("messy_csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, keep_empty=True)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def src_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV read with inferred types, then set to the widths wanted."""
    path = workspace(spark).path("orders_csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )
    write_csv(orders, path)
    return read_csv(spark, path).select(
        F.col("o_orderkey").cast("bigint"),
        F.col("o_custkey").cast("bigint"),
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("date"),
    )


_LOADED = struct_of(columns("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"))
# Every 50th customer's nation is not a number in the file.
_NATION_TEXT = "CASE WHEN c_custkey % 50 = 0 THEN 'n/' || CAST(c_nationkey AS STRING) ELSE CAST(c_nationkey AS STRING) END"


def _load_customer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    store = workspace(spark)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", f"{_NATION_TEXT} AS c_nationkey", "c_mktsegment"
    )
    write_csv(rows, store.path("customer_csv"))
    return load_delimited(spark, store.path("customer_csv"), _LOADED, "customer", store)


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 50 <> 0")
def load_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load into declared types: the lines that fit."""
    return _load_customer(spark, sf_dir)[0]


@query(
    f"SELECT CAST(c_custkey AS STRING) || ',' || c_name || ',' || {_NATION_TEXT} || ',' || c_mktsegment AS line"
    " FROM customer WHERE c_custkey % 50 = 0"
)
def load_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load into declared types: the lines set aside."""
    return _load_customer(spark, sf_dir)[1]


@query("SELECT * FROM orders")
def src_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(_database(spark))
    store.save("orders", table(spark, sf_dir, "orders"))
    return _finished(catalog.scan_table(spark, "orders", store.database), store.database)


@query(
    "SELECT 'part' AS kind, p_partkey AS id, p_name AS name FROM part"
    " UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier"
)
def catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables found in a folder by a name pattern, then read by name: all their rows."""
    database = _database(spark)
    found = catalog.register_folder(spark, sf_dir, database, "%p%", ".parquet")
    assert f"{database}.part" in found and f"{database}.supplier" in found
    part, supplier = spark.table(f"{database}.part"), spark.table(f"{database}.supplier")
    parts = part.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return _finished(parts.union(supplier.select(F.lit("supplier"), "s_suppkey", "s_name")), database)


# Three loads of one table: a key that widens, a column that comes later.
_LOADS = {
    "first": ("o_orderkey % 3 = 0", ["o_orderkey", "CAST(o_custkey AS INT) AS o_custkey", "o_orderstatus"]),
    "second": ("o_orderkey % 3 = 1", ["o_orderkey", "CAST(o_custkey AS BIGINT) AS o_custkey", "o_orderstatus", "o_orderpriority"]),
    "third": ("o_orderkey % 3 = 2", ["o_orderkey", "CAST(o_custkey AS DECIMAL(12,2)) AS o_custkey", "o_orderpriority", "o_orderstatus"]),
}


def _drifted_lake(spark: SparkSession, sf_dir: str) -> str:
    store = FolderStore(workspace(spark).path("lake"))
    for name, (rows, cols) in _LOADS.items():
        store.save(name, table(spark, sf_dir, "orders").where(rows).selectExpr(*cols))
    return store.base


@query(
    """
    WITH n AS (
        SELECT count(*) AS rows, count(*) FILTER (o_orderkey % 3 = 0) AS a, count(*) FILTER (o_orderkey % 3 = 1) AS b,
               count(*) FILTER (o_orderkey % 3 = 2) AS c FROM orders
    )
    SELECT 'o_orderkey' AS column_name, 'bigint' AS type, rows, 'bigint' AS common_type, 0::BIGINT AS missing_rows FROM n
    UNION ALL SELECT 'o_custkey', 'int', a, 'decimal(22,2)', 0 FROM n
    UNION ALL SELECT 'o_custkey', 'bigint', b, 'decimal(22,2)', 0 FROM n
    UNION ALL SELECT 'o_custkey', 'decimal(12,2)', c, 'decimal(22,2)', 0 FROM n
    UNION ALL SELECT 'o_orderstatus', 'string', rows, 'string', 0 FROM n
    UNION ALL SELECT 'o_orderpriority', 'string', b + c, 'string', a FROM n
    """
)
def crawl_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What drifted between three loads into one folder, from all files' footers."""
    return drift(spark, _drifted_lake(spark, sf_dir)).drop("files")


@query(
    """SELECT o_orderkey, CAST(o_custkey AS DECIMAL(22,2)) AS o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_orderpriority FROM orders"""
)
def crawl_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three loads read as one table of the types that hold all of them."""
    database = _database(spark)
    crawl(spark, _drifted_lake(spark, sf_dir), f"{database}.orders")
    return _finished(spark.table(f"{database}.orders"), database)


@query("SELECT o_orderkey, o_custkey FROM orders")
def database_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database is made, listed and used: its table is found by its bare name."""
    database, before = _database(spark), spark.catalog.currentDatabase()
    TableStore(database).save("orders", table(spark, sf_dir, "orders"))
    assert database in catalog.list_databases(spark)
    catalog.use_database(spark, database)
    try:
        orders = spark.table("orders").select("o_orderkey", "o_custkey")
    finally:
        catalog.use_database(spark, before)
    return _finished(orders, database)


@query(
    "SELECT DISTINCT c_custkey, n_nationkey, c_name, c_acctbal, c_mktsegment FROM"
    f" ({WIDE_SQL}) w"
)
def ddl_create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A star declared by DDL, filled by insert, read back by name."""
    database = _database(spark)
    catalog.create_star_tables(spark, ORDERS_STAR, database)
    build_star(wide(spark, sf_dir), ORDERS_STAR, TableStore(database))
    found = spark.sql(
        f"""SELECT c_custkey, n_nationkey, c_name, c_acctbal, c_mktsegment
        FROM {database}.customer LEFT JOIN {database}.segment USING (segment_id)"""
    )
    return _finished(found, database)


@query(
    "SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'"
)
def sql_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return spark.sql(
        """SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status
        FROM orders_view WHERE o_orderstatus = 'F'"""
    )


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def peek_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows in a stated order."""
    return catalog.peek(table(spark, sf_dir, "orders"), 20, F.desc("o_totalprice"), "o_orderkey")


@query(
    f"""SELECT 'profile' AS table_name, count(DISTINCT (o_orderstatus, o_orderpriority)) AS n_rows FROM ({WIDE_SQL}) w
    UNION ALL SELECT 'segment', count(DISTINCT c_mktsegment) FROM ({WIDE_SQL}) w
    UNION ALL SELECT 'region', count(DISTINCT r_name) FROM ({WIDE_SQL}) w
    UNION ALL SELECT 'nation', count(DISTINCT n_nationkey) FROM ({WIDE_SQL}) w
    UNION ALL SELECT 'customer', count(DISTINCT c_custkey) FROM ({WIDE_SQL}) w
    UNION ALL SELECT 'orders', count(*) FROM ({WIDE_SQL}) w"""
)
def write_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables written in reference order, read back from their folder."""
    store = FolderStore(workspace(spark).path("star"))
    build_star(wide(spark, sf_dir), ORDERS_STAR, store)
    return row_counts({t: store.load(spark, t) for t in ORDERS_STAR.write_order})


class _Interrupted(Exception):
    pass


@query(WIDE_SQL)
def publish_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads published, a third that fails after its dimensions: readers see the second whole."""
    versions = Versions(spark, workspace(spark).path("star"))
    rows = wide(spark, sf_dir)
    with versions.publishing() as store:
        build_star(rows.where("o_orderdate < DATE '1995-01-01'"), ORDERS_STAR, store)
    with versions.publishing() as store:
        build_star(rows, ORDERS_STAR, store)
    with suppress(_Interrupted), versions.publishing() as store:
        build_star(rows.where("o_orderdate >= DATE '1995-01-01'"), ORDERS_STAR, store, only=["customer", "nation"])
        raise _Interrupted
    versions.remove_old()
    return denormalize(ORDERS_STAR, versions.tables())
