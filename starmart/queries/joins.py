"""Lookups and the joins they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.dims import distinct_rows, extract_dim, frequent_tuples
from starmart.operators.lookup import fan_out, lookup, lookup_large
from starmart.queries import oracle as O
from starmart.queries.dims import STAY
from starmart.queries.inputs import MESSY_SQL, messy, table
from starmart.queries.registry import query


@query(
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders"
    " LEFT JOIN customer ON o_custkey = c_custkey"
)
def join_left_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return lookup_large(
        orders,
        customer,
        ["o_custkey"],
        ["c_name", "c_mktsegment"],
        spread_by=["o_orderkey"],
        null_safe=False,
    )


_STAY_ID = f"SELECT id, {O.rank_key(STAY)} AS stay_id FROM ({MESSY_SQL}) m"


@query(_STAY_ID)
def dim_lookup_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key lookup on four columns with NULLs: every row finds its key."""
    rows = messy(spark, sf_dir)
    dim = extract_dim(rows, STAY, "stay_id")
    return lookup(rows, dim, STAY, "stay_id", check_unique=True).select("id", "stay_id")


@query(_STAY_ID)
def dim_lookup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup with the rows of frequent tuples split into parts."""
    rows = messy(spark, sf_dir)
    dim = extract_dim(rows, STAY, "stay_id")
    hot = frequent_tuples(rows, {"stay": STAY})["stay"]
    return lookup(rows, dim, STAY, "stay_id", hot=hot, spread_by=["id"]).select("id", "stay_id")


_FIRST_ORDER = (
    "SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey, o_totalprice::DECIMAL(15,2))"
    " AS first_order FROM orders"
)


def _mixed_types(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders with INT and DECIMAL(12,3) keys, and a dimension with BIGINT and DECIMAL(15,2)."""
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    keys = orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("c"), price.cast("decimal(12,3)").alias("p"))
    dim = orders.groupBy(F.col("o_custkey").cast("long").alias("c"), price.cast("decimal(15,2)").alias("p"))
    return keys, dim.agg(F.min("o_orderkey").alias("first_order"))


@query(_FIRST_ORDER)
def lookup_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose two sides have different types match by value."""
    keys, dim = _mixed_types(spark, sf_dir)
    return lookup(keys, dim, ["c", "p"], "first_order").select("o_orderkey", "first_order")


@query(_FIRST_ORDER)
def lookup_mixed_types_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with frequent tuples split."""
    keys, dim = _mixed_types(spark, sf_dir)
    found = lookup_large(keys, dim, ["c", "p"], "first_order", spread_by=["o_orderkey"], hot_share=0.001)
    return found.select("o_orderkey", "first_order")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS found,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS found_decimal
    FROM orders
    """
)
def lookup_wide_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys beyond what the common type holds: a neighbour that it rounds to is no match.

    BIGINT keys from 2^53 on, two thirds of them odd, meet DOUBLE ones, which step by 2 there. DECIMAL(38,0) keys meet
    DECIMAL(38,20) ones, every second of them off by 10^-20.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    far = 1 << 53
    # Even numbers from 2^53 on are DOUBLEs, odd ones are not: doubled keys are, and one more is rounded.
    wide = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") * 2 + far).otherwise(F.col("o_orderkey") * 2 + (far + 1)).alias("k"),
        F.col("o_orderkey").cast("decimal(38,0)").alias("d"),
    )
    doubles = orders.select((F.col("o_orderkey") * 2 + far).cast("double").alias("k"), F.col("o_orderkey").alias("found"))
    # As a text: a sum of decimals would lose the last digit.
    off = F.when(F.col("o_orderkey") % 2 == 0, ".0").otherwise(".00000000000000000001")
    exact = F.concat(F.col("o_orderkey").cast("string"), off).cast("decimal(38,20)")
    decimals = orders.select(exact.alias("d"), F.col("o_orderkey").alias("found_decimal"))
    once = lookup(wide, doubles, ["k"], "found")
    return lookup(once, decimals, ["d"], "found_decimal").select("o_orderkey", "found", "found_decimal")


_NO_NULLS = " AND ".join(f"{c} IS NOT NULL" for c in STAY)


@query(f"SELECT id, CASE WHEN {_NO_NULLS} THEN stay_id END AS stay_id FROM ("
       f"SELECT id, {', '.join(STAY)}, {O.rank_key(STAY)} AS stay_id FROM ({MESSY_SQL}) m) k")
def dim_lookup_null_unsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup by plain equality: rows with a NULL stay without a key."""
    rows = messy(spark, sf_dir)
    dim = extract_dim(rows, STAY, "stay_id")
    return lookup(rows, dim, STAY, "stay_id", null_safe=False).select("id", "stay_id")


_PROFILE = ["o_orderstatus", "o_orderpriority"]
_PROFILE_DIM_SQL = O.dim("SELECT * FROM orders", _PROFILE, "profile_id")


@query(
    f"SELECT o_orderkey, o.o_orderstatus AS o_orderstatus, profile_id FROM orders o"
    f" LEFT JOIN ({_PROFILE_DIM_SQL}) p ON o.o_orderstatus = p.o_orderstatus"
)
def join_partial_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup on part of a dimension's columns: each match is a row of its own."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *_PROFILE)
    dim = extract_dim(orders, _PROFILE, "profile_id")
    joined = lookup(orders, dim, ["o_orderstatus"], "profile_id", check_unique=True, allow_fan_out=True)
    return joined.select("o_orderkey", "o_orderstatus", "profile_id")


@query(
    """SELECT l.o_orderstatus AS o_orderstatus, left_rows, dim_rows, left_rows * dim_rows AS joined_rows
    FROM (SELECT o_orderstatus, count(*) AS left_rows FROM orders GROUP BY o_orderstatus) l
    JOIN (SELECT o_orderstatus, count(DISTINCT o_orderpriority) AS dim_rows FROM orders GROUP BY o_orderstatus) r
    ON l.o_orderstatus = r.o_orderstatus"""
)
def join_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the partial-key join yields, counted from aggregates of both sides."""
    orders = table(spark, sf_dir, "orders")
    return fan_out(orders, distinct_rows(orders, _PROFILE), ["o_orderstatus"])


_VERIFIED = ["host_verifications", "host_is_superhost"]
_VERIFIED_DIM_SQL = f"""SELECT host_verifications, host_is_superhost, count(*) AS n_listings
  FROM ({MESSY_SQL}) m WHERE host_response_time IS NULL GROUP BY host_verifications, host_is_superhost"""


@query(
    f"SELECT a.id AS id, b.n_listings AS n_listings FROM ({MESSY_SQL}) a JOIN ({_VERIFIED_DIM_SQL}) b"
    f" ON {O.same('a', 'b', _VERIFIED)}"
)
def join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join in which NULL meets NULL; rows without a match go."""
    rows = messy(spark, sf_dir)
    dim = (
        rows.where(F.col("host_response_time").isNull())
        .groupBy(*_VERIFIED)
        .agg(F.count(F.lit(1)).alias("n_listings"))
    )
    return lookup(rows, dim, _VERIFIED, "n_listings", how="inner").select("id", "n_listings")
