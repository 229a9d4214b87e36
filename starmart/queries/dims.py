"""Dimensions, surrogate keys, snowflakes, fact tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.checks import row_conservation
from starmart.operators.dims import distinct_rows, extract_dim
from starmart.operators.key_registry import KeyRegistry
from starmart.operators.quarantine import Counting
from starmart.plans.layout import BucketedStar
from starmart.plans.orders import ORDERS_STAR, orders_by_profile
from starmart.plans.star import build_star, denormalize
from starmart.queries import oracle as O
from starmart.queries.inputs import MESSY_SQL, WIDE_SQL, messy, wide
from starmart.queries.registry import query
from starmart.sources.catalog import create_database
from starmart.sources.store import workspace
from starmart.spec import Dimension, Reference, Star, columns

PROFILE = ["o_orderstatus", "o_orderpriority", "c_mktsegment"]
GEO = ["n_name", "r_name"]
STAY = ["host_response_time", "host_is_superhost", "bathrooms_text", "first_review"]


@query(f"SELECT DISTINCT {', '.join(PROFILE)} FROM ({WIDE_SQL}) w")
def dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(wide(spark, sf_dir), PROFILE)


@query(O.dim(WIDE_SQL, PROFILE, "profile_id"))
def dim_extract_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_dim(wide(spark, sf_dir), PROFILE, "profile_id")


@query(O.dim(WIDE_SQL, ["c_mktsegment"], "segment_id"))
def dim_extract_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_dim(wide(spark, sf_dir), ["c_mktsegment"], "segment_id")


@query(O.dim(WIDE_SQL, GEO, "geo_id"))
def dim_extract_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_dim(wide(spark, sf_dir), GEO, "geo_id")


@query(O.dim(MESSY_SQL, STAY, "stay_id"))
def dim_extract_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension over columns with NULLs, which are equal to each other."""
    return extract_dim(messy(spark, sf_dir), STAY, "stay_id")


@query(O.dim(WIDE_SQL, ["c_custkey", "o_orderdate"], "day_id"))
def key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys over a dimension about as large as its source."""
    return extract_dim(wide(spark, sf_dir), ["c_custkey", "o_orderdate"], "day_id")


def _uniqueness(dim: DataFrame, key: str) -> DataFrame:
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count(key).alias("n_keys")
    )


_UNIQUE_SQL = """SELECT count(*) AS n_rows, count(*) AS n_keys
  FROM (SELECT DISTINCT {cols} FROM ({source}) s) d"""


@query(_UNIQUE_SQL.format(cols="c_custkey, o_orderdate", source=WIDE_SQL))
def key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition-based ids: as many keys as rows."""
    dim = extract_dim(wide(spark, sf_dir), ["c_custkey", "o_orderdate"], "day_id", "monotonic")
    return _uniqueness(dim, "day_id")


@query(_UNIQUE_SQL.format(cols=", ".join(STAY), source=MESSY_SQL))
def key_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys over columns with NULLs: as many keys as rows."""
    return _uniqueness(extract_dim(messy(spark, sf_dir), STAY, "stay_id", "hash"), "stay_id")


_DAY_STAR = Star(
    dimensions=(Dimension("day", "day_id", columns("c_custkey bigint, o_orderdate date")),),
    fact=Dimension(
        "orders",
        "o_orderkey",
        columns("o_orderkey bigint, o_totalprice decimal(15,2)"),
        natural_key=True,
        references=(Reference("day_id", "day"),),
    ),
)


@query(f"SELECT o_orderkey, o_totalprice, c_custkey, o_orderdate FROM ({WIDE_SQL}) w")
def key_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of 24 bits for a dimension about as large as its source, so that many collide:
    every fact still finds its own tuple."""
    tables = build_star(wide(spark, sf_dir), _DAY_STAR, key_bits=24)
    return denormalize(_DAY_STAR, tables)


_SNOWFLAKE_SQL = f"""SELECT c_custkey, segment_id, n_nationkey, c_name, c_acctbal, region_id FROM (
  SELECT DISTINCT c_custkey, {O.rank_key(['c_mktsegment'])} AS segment_id, n_nationkey, c_name,
    c_acctbal, {O.rank_key(['r_name'])} AS region_id FROM ({WIDE_SQL}) w) d"""


@query(_SNOWFLAKE_SQL)
def dim_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer with its segment key, and its nation with the region key."""
    tables = build_star(wide(spark, sf_dir), ORDERS_STAR, key_kind="dense", only=["customer", "nation"])
    nation = tables["nation"].select("n_nationkey", "region_id")
    return tables["customer"].join(nation, "n_nationkey", "left")


_PROFILE_ID = O.rank_key(["o_orderstatus", "o_orderpriority"])


@query(f"SELECT o_orderkey, {_PROFILE_ID} AS profile_id, c_custkey, o_orderdate, o_totalprice FROM ({WIDE_SQL}) w")
def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(wide(spark, sf_dir), ORDERS_STAR, key_kind="dense", only=["orders"])["orders"]


@query(WIDE_SQL)
def star_denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split with hash keys and put back together: the wide table again."""
    tables = build_star(wide(spark, sf_dir), ORDERS_STAR, key_kind="hash")
    return denormalize(ORDERS_STAR, tables)


@query(WIDE_SQL)
def star_denormalize_split_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with dense keys and hot groups split off in every lookup."""
    tables = build_star(wide(spark, sf_dir), ORDERS_STAR, key_kind="dense", hot_share=0.001)
    return denormalize(ORDERS_STAR, tables, hot_share=0.001)


@query(WIDE_SQL)
def star_denormalize_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid out by customer and joined back: the largest join shuffles nothing."""
    tables = build_star(wide(spark, sf_dir), ORDERS_STAR)
    store = workspace(spark)
    database = f"starmart_{uuid.uuid4().hex}"
    create_database(spark, database, store.path("database"))
    layout = BucketedStar(ORDERS_STAR, spark, database, "customer", 8)
    layout.save(tables)
    found = store.save("wide", layout.denormalize())
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


@query(
    "SELECT count(*) AS source_rows, count(*) AS fact_rows, count(DISTINCT o_orderkey) AS fact_keys,"
    " count(*) = count(DISTINCT o_orderkey) AS conserved FROM orders",
    "row_conservation",
)
def _row_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide(spark, sf_dir)
    return row_conservation(rows, build_star(rows, ORDERS_STAR)["orders"], "o_orderkey")


_TABLE_TUPLES = {
    "clean": "o_orderkey",
    "profile": "o_orderstatus, o_orderpriority",
    "segment": "c_mktsegment",
    "region": "r_name",
    "nation": "n_nationkey, n_name, r_name",
    "customer": "c_custkey, c_name, c_acctbal, c_mktsegment, n_nationkey",
    "orders": "o_orderkey",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM (SELECT DISTINCT {cols} FROM ({WIDE_SQL}) w) t"
        for name, cols in _TABLE_TUPLES.items()
    )
)
def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the source's clean copy and of every table, observed while they were written."""
    store = Counting(workspace(spark))
    build_star(store.save("clean", wide(spark, sf_dir)), ORDERS_STAR, store, staged=True)
    return spark.createDataFrame(list(store.rows.items()), "table_name string, n_rows bigint")


FLAGSHIP_SQL = f"""SELECT o_orderstatus, o_orderpriority, c_mktsegment, r_name, count(*) AS n_orders,
  CAST(sum(o_totalprice) AS DECIMAL(25,2)) AS total_price
FROM ({WIDE_SQL}) w GROUP BY o_orderstatus, o_orderpriority, c_mktsegment, r_name"""


@query(FLAGSHIP_SQL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source to star to report: load, read back, denormalise, aggregate."""
    tables = build_star(wide(spark, sf_dir), ORDERS_STAR)
    return orders_by_profile(denormalize(ORDERS_STAR, tables))


_BATCH = "CASE WHEN o_orderdate < DATE '1995-01-01' THEN 1 ELSE 2 END"


@query(
    f"""WITH w AS ({WIDE_SQL}), t AS (
        SELECT o_orderdate, c_mktsegment, min({_BATCH}) AS first_batch, max({_BATCH}) AS last_batch FROM w
        GROUP BY o_orderdate, c_mktsegment
    ), k AS (
        SELECT *, row_number() OVER (ORDER BY first_batch, o_orderdate NULLS FIRST, c_mktsegment NULLS FIRST) - 1 AS day_id FROM t
    )
    SELECT CAST(b AS INTEGER) AS batch, day_id, o_orderdate, c_mktsegment FROM k, (VALUES (1), (2)) v(b)
    WHERE b BETWEEN first_batch AND last_batch""",
)
def key_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two loads: the second's known tuples keep their keys, new ones are numbered after them."""
    rows = wide(spark, sf_dir).select("o_orderdate", "c_mktsegment")
    store = workspace(spark)
    name = f"keys_{uuid.uuid4().hex}"
    registry = KeyRegistry.create(spark, name, "day_id", rows.schema.fields, 8, store.path("registry"))
    batch = F.expr(_BATCH)
    loads = []
    for n in (1, 2):
        tuples = registry.extract_dim(rows.where(batch == n), workspace(spark))
        loads.append(store.save(f"batch_{n}", tuples.withColumn("batch", F.lit(n))))
    registry.drop()
    return loads[0].union(loads[1])
