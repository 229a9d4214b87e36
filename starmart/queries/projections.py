"""Projections, predicates, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.columns import key_first, rename
from starmart.queries.inputs import MESSY_SQL, messy, table
from starmart.queries.registry import query


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def proj_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").drop("c_nationkey", "c_acctbal", "not_there")


@query(
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal,"
    " c_mktsegment FROM customer"
)
def proj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"c_custkey": "customer_id", "c_name": "customer_name"}
    return rename(table(spark, sf_dir, "customer"), names)


@query("SELECT p_name AS title, p_brand, p_partkey FROM part")
def proj_copy_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename in two steps: copy under the new name, drop the old column."""
    part = table(spark, sf_dir, "part")
    return part.withColumn("title", F.col("p_name")).drop("p_name").select(
        "title", "p_brand", "p_partkey"
    )


@query("SELECT p_partkey, p_brand, p_type, p_size FROM part")
def proj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")


@query("SELECT * FROM supplier")
def proj_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("*")


@query(
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size + 1 AS INTEGER) AS p_size,"
    " p_retailprice, p_brand || '/' || p_type AS label FROM part"
)
def proj_with_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace one column and add one."""
    return (
        table(spark, sf_dir, "part")
        .withColumn("p_size", F.col("p_size") + 1)
        .withColumn("label", F.concat_ws("/", "p_brand", "p_type"))
    )


@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,"
    " CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag = 'R' AS returned FROM lineitem"
)
def proj_with_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace and add many columns in one projection."""
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {
            "l_quantity": F.col("l_quantity").cast("int"),
            "l_shipdate": F.col("l_shipdate").cast("date"),
            "returned": F.col("l_returnflag") == "R",
        }
    )
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "returned")


@query("SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def proj_key_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_first(table(spark, sf_dir, "orders"), "o_custkey")


@query(
    f"""SELECT column_name, CAST(n AS BIGINT) AS n_null FROM (
      SELECT 'host_response_rate' AS column_name, count(*) AS n FROM ({MESSY_SQL}) m WHERE host_response_rate IS NULL
      UNION ALL SELECT 'bathrooms_text', count(*) FROM ({MESSY_SQL}) m WHERE bathrooms_text IS NULL
      UNION ALL SELECT 'first_review', count(*) FROM ({MESSY_SQL}) m WHERE first_review IS NULL) t"""
)
def filter_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messy(spark, sf_dir)
    parts = [
        rows.where(F.col(c).isNull())
        .agg(F.count(F.lit(1)).alias("n_null"))
        .select(F.lit(c).alias("column_name"), "n_null")
        for c in ("host_response_rate", "bathrooms_text", "first_review")
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(f"SELECT id, host_id, bathrooms_text FROM ({MESSY_SQL}) m WHERE bathrooms_text = 'Half-bath'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        messy(spark, sf_dir)
        .where(F.col("bathrooms_text") == "Half-bath")
        .select("id", "host_id", "bathrooms_text")
    )


@query("SELECT * FROM orders WHERE o_custkey IN (3, 14, 159, 265, 358, 979, 1323, 8462)")
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of named customers; the list reaches the Parquet scan."""
    named = (3, 14, 159, 265, 358, 979, 1323, 8462)
    return table(spark, sf_dir, "orders").where(F.col("o_custkey").isin(*named))


@query(
    f"SELECT DISTINCT bathrooms_text, host_verifications FROM ({MESSY_SQL}) m"
    " WHERE host_response_time IS NULL"
)
def filter_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        messy(spark, sf_dir)
        .where(F.col("host_response_time").isNull())
        .select("bathrooms_text", "host_verifications")
        .distinct()
    )
