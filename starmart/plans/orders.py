"""A snowflaked star over order, customer, nation and region tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.lookup import lookup_large
from starmart.spec import Dimension, Reference, Star, columns

ORDERS_STAR = Star(
    dimensions=(
        Dimension("profile", "profile_id", columns("o_orderstatus string, o_orderpriority string")),
        Dimension("segment", "segment_id", columns("c_mktsegment string")),
        Dimension("region", "region_id", columns("r_name string")),
        Dimension(
            "nation",
            "n_nationkey",
            columns("n_nationkey int, n_name string"),
            natural_key=True,
            references=(Reference("region_id", "region"),),
        ),
        Dimension(
            "customer",
            "c_custkey",
            columns("c_custkey bigint, c_name string, c_acctbal decimal(15,2)"),
            natural_key=True,
            references=(Reference("segment_id", "segment"), Reference("n_nationkey", "nation")),
        ),
    ),
    fact=Dimension(
        "orders",
        "o_orderkey",
        columns("o_orderkey bigint, o_orderdate date, o_totalprice decimal(15,2)"),
        natural_key=True,
        references=(Reference("profile_id", "profile"), Reference("c_custkey", "customer")),
    ),
)


def wide_orders(
    orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """The wide table: every order with its customer, nation and region.

    Nation and region are broadcast by Spark from their sizes. A customer may have
    any share of the orders.
    """
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    buyer = ["c_name", "c_acctbal", "c_mktsegment", "c_nationkey"]
    sold = lookup_large(
        orders,
        customer.withColumnRenamed("c_custkey", "o_custkey"),
        ["o_custkey"],
        buyer,
        spread_by=["o_orderkey"],
        null_safe=False,
    )
    return sold.join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_custkey").alias("c_custkey"),
        "c_name",
        F.col("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"),
        "c_mktsegment",
        F.col("c_nationkey").alias("n_nationkey"),
        "n_name",
        "r_name",
    )


def orders_by_profile(wide: DataFrame) -> DataFrame:
    """Report over the wide (or denormalised) table."""
    return wide.groupBy("o_orderstatus", "o_orderpriority", "c_mktsegment", "r_name").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").cast("decimal(25,2)").alias("total_price"),
    )
