"""Integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import checks as C
from starmart.queries.inputs import MESSY_SQL, messy, table
from starmart.queries.registry import query
from starmart.spec import Column


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
    'duplicate' AS issue FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.pk_violations(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    f"""SELECT host_response_time, count(*) AS n_rows,
    CASE WHEN host_response_time IS NULL THEN 'null' ELSE 'duplicate' END AS issue
    FROM ({MESSY_SQL}) m GROUP BY host_response_time HAVING count(*) > 1 OR host_response_time IS NULL"""
)
def pk_violations_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.pk_violations(messy(spark, sf_dir), "host_response_time")


@query(
    """SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') GROUP BY o_custkey"""
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is missing from a customer table that lost a segment."""
    some = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return C.fk_orphans(table(spark, sf_dir, "orders"), "o_custkey", some, "c_custkey")


@query(
    f"""SELECT first_review, count(*) AS n_rows FROM ({MESSY_SQL}) m WHERE first_review IS NULL
    OR first_review NOT IN (SELECT CAST(CAST(l_shipdate AS DATE) AS STRING) FROM lineitem
      WHERE l_shipdate IS NOT NULL) GROUP BY first_review"""
)
def fk_orphans_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References without a target, NULL references among them."""
    days = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").cast("string").alias("day")
    )
    return C.fk_orphans(messy(spark, sf_dir), "first_review", days.distinct(), "day")


_FKS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
)


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{fk}' AS column_name, count(*) AS n_orphans
        FROM {t} WHERE {fk} IS NULL OR {fk} NOT IN (SELECT {key} FROM {parent})"""
        for t, fk, parent, key in _FKS
    )
)
def fk_orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        C.fk_orphans(table(spark, sf_dir, t), fk, table(spark, sf_dir, parent), key)
        .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_orphans"))
        .select(F.lit(t).alias("table_name"), F.lit(fk).alias("column_name"), "n_orphans")
        for t, fk, parent, key in _FKS
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


_LIMITS = {"text": 10000, "lang": 2, "source": 4}


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {n} AS max_len, CAST(max(length({c})) AS INTEGER) AS longest,
        count(*) FILTER (WHERE length({c}) > {n}) AS n_over FROM documents"""
        for c, n in _LIMITS.items()
    )
)
def varchar_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.text_overflow(table(spark, sf_dir, "documents"), _LIMITS)


@query("SELECT doc_id, substr(text, 1, 2000) AS text, source FROM documents")
def varchar_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut to a declared width, the one operator that shortens them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return C.truncate_texts(documents, {"text": 2000})


@query(
    """SELECT p_brand, count(*) AS n_rows FROM part WHERE p_brand NOT IN
    (SELECT 'Brand#' || CAST(n_nationkey AS STRING) FROM nation WHERE n_regionkey < 3) GROUP BY p_brand"""
)
def lookup_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a reference list does not have."""
    listed = (
        table(spark, sf_dir, "nation")
        .where(F.col("n_regionkey") < 3)
        .select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("brand"))
    )
    return C.not_in_list(table(spark, sf_dir, "part"), "p_brand", listed, "brand")


_DECLARED = (
    Column("c_custkey", "bigint", nullable=False),
    Column("c_name", "string", max_len=10),
    Column("c_nationkey", "bigint"),
    Column("c_acctbal", "decimal(5,2)"),
    Column("c_mktsegment", "string", max_len=9),
    Column("c_phone", "string"),
)


@query(
    """SELECT 'c_custkey' AS column_name, 'bigint' AS expected, 'bigint' AS actual, 'ok' AS issue,
      count(*) FILTER (WHERE c_custkey IS NULL) AS n_bad FROM customer
    UNION ALL SELECT 'c_name', 'string', 'string', 'ok', count(*) FILTER (WHERE length(c_name) > 10) FROM customer
    UNION ALL SELECT 'c_nationkey', 'bigint', 'int', 'type', CAST(0 AS BIGINT)
    UNION ALL SELECT 'c_acctbal', 'decimal(5,2)', 'double', 'type',
      count(*) FILTER (WHERE try_cast(c_acctbal AS DECIMAL(5,2)) IS NULL) FROM customer
    UNION ALL SELECT 'c_mktsegment', 'string', 'string', 'ok',
      count(*) FILTER (WHERE length(c_mktsegment) > 9) FROM customer
    UNION ALL SELECT 'c_phone', 'string', NULL, 'missing', count(*) FROM customer"""
)
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declaration against the data: types compared, offending values counted."""
    return C.schema_conformance(table(spark, sf_dir, "customer"), _DECLARED)
