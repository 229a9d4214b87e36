"""Keys of different types, texts with odd white space, clocks set back."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.casting import integer_text, number_text
from starmart.operators.dims import frequent_tuples
from starmart.operators.keys import hash_key
from starmart.operators.lookup import FanOutError, lookup, lookup_hash, lookup_keys, lookup_large
from starmart.operators.profile import profile
from starmart.plans.orders import ORDERS_STAR
from starmart.plans.star import build_star, denormalize


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("cols", [["a"], ["a", "b"]])
@pytest.mark.parametrize("hot_share", [0.001, None])
def test_lookup_matches_values_of_different_types(spark, null_safe, cols, hot_share):
    left = spark.createDataFrame([(1, Decimal("2.5"), 7), (3, Decimal("4"), 8)], "a int, b decimal(12,3), id int")
    right = spark.createDataFrame([(1, Decimal("2.5"), "x"), (5, Decimal("4"), "y")], "a long, b decimal(10,2), v string")
    found = lookup_large(left, right, cols, "v", spread_by=["id"], hot_share=hot_share, null_safe=null_safe)
    assert {(r["id"], r["v"]) for r in found.collect()} == {(7, "x"), (8, None)}
    assert found.dtypes[:2] == left.dtypes[:2]


def test_hot_tuples_are_found_in_the_common_type(spark):
    left = spark.range(1000).select(F.lit(1).cast("int").alias("a"), "id")
    right = spark.createDataFrame([(1, "x")], "a long, v string")
    hot = frequent_tuples(left, {"a": lookup_keys(left, right, ["a"])})["a"]
    assert len(hot) == 1
    found = lookup(left, right, ["a"], "v", hot=hot, spread_by=["id"])
    assert found.where("v = 'x'").count() == 1000


WIDE = [
    # BIGINT and DOUBLE: 2^53 + 1 rounds to 2^53, 2^63 - 1 to 2^63.
    ("long", "double", (1 << 53) + 1, float(1 << 53), False),
    ("long", "double", 1 << 53, float(1 << 53), True),
    ("long", "double", (1 << 63) - 1, float(1 << 63), False),
    ("double", "long", float(1 << 53), (1 << 53) + 1, False),
    ("double", "long", 1e300, 1, False),
    ("int", "float", (1 << 24) + 1, float(1 << 24), False),
    ("decimal(38,0)", "decimal(38,20)", Decimal(1), Decimal("1.00000000000000000001"), False),
    ("decimal(38,20)", "decimal(38,0)", Decimal("1.00000000000000000001"), Decimal(1), False),
    ("decimal(38,0)", "decimal(38,20)", Decimal(7), Decimal(7), True),
    ("decimal(38,0)", "decimal(38,20)", Decimal(10**37), Decimal(1), False),
    ("long", "double", None, None, True),
]


@pytest.mark.parametrize("left_type, right_type, a, b, same", WIDE)
@pytest.mark.parametrize("hot", [False, True])
def test_values_that_no_common_type_holds_match_nothing(spark, left_type, right_type, a, b, same, hot):
    left = spark.createDataFrame([(a, 1)], f"k {left_type}, id int")
    right = spark.createDataFrame([(b, "x")], f"k {right_type}, v string")
    hashes = [r[0] for r in left.select(hash_key(lookup_keys(left, right, ["k"]))).collect()] if hot else ()
    found = lookup(left, right, ["k"], "v", hot=hashes, spread_by=["id"]).collect()
    assert [(r["k"], r["v"]) for r in found] == [(a, "x" if same else None)]
    hashed = [df.select(lookup_hash(df, other, ["k"]).alias("h")).first()["h"] for df, other in ((left, right), (right, left))]
    assert (None not in hashed and hashed[0] == hashed[1]) == same


def test_types_that_hold_all_values_need_no_test(spark):
    left, right = spark.range(2).select(F.col("id").cast("int").alias("k")), spark.range(2).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert "try_cast" not in lookup(left, right, ["k"], "v")._jdf.queryExecution().toString().lower()


def test_text_and_number_have_no_common_type(spark):
    left = spark.createDataFrame([("1",)], "a string")
    right = spark.createDataFrame([(1, 2)], "a int, v int")
    with pytest.raises(TypeError, match="string and int"):
        lookup(left, right, ["a"], "v")


ODD = ["12", "\t12", "12\n", "\r12", " 12 ", "+12", "-12", "\x0012", "\x7f12", ".5", "1e3", "N/A", "", " ", "\t", "1 2", "--1", None]


def test_gate_loses_no_number(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    both = df.select(
        number_text(F.col("t"), "double").alias("gated"), F.col("t").try_cast("double").alias("plain"), "t"
    )
    assert [r["t"] for r in both.where("NOT (gated <=> plain)").collect()] == []
    whole = df.select(integer_text(F.col("t"), "int").alias("i"), F.col("t").try_cast("int").alias("plain"), "t")
    assert [r["t"] for r in whole.where("plain IS NOT NULL AND NOT (i <=> plain)").collect()] == []


def test_two_hours_of_a_clock_set_back_are_two(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    # 1:30 before and after the clock was set back on 6 November 2022.
    autumn = spark.sql("SELECT timestamp_seconds(s) AS t FROM VALUES (1667712600), (1667716200) AS v(s)")
    assert autumn.select(F.col("t").cast("string")).distinct().count() == 1
    assert profile(autumn).first()["n_distinct"] == autumn.distinct().count() == 2


def test_join_back_refuses_repeated_natural_keys(spark):
    names = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority", "c_custkey", "c_name"]
    names += ["c_acctbal", "c_mktsegment", "n_nationkey", "n_name", "r_name"]
    row = ("2024-01-01", "1", "O", "1", "7", "C", "2", "M", "3", "N", "R")
    text = spark.createDataFrame([("1", *row), ("2", *row)], names)
    kinds = {c.name: c.type for t in ORDERS_STAR.write_order for c in ORDERS_STAR.table_columns(t)}
    rows = text.select(*[F.col(n).cast(kinds[n]).alias(n) for n in names])
    tables = dict(build_star(rows, ORDERS_STAR))
    again = tables["customer"].withColumn("c_name", F.lit("D"))
    tables["customer"] = tables["customer"].unionByName(again)
    with pytest.raises(FanOutError, match="customer"):
        denormalize(ORDERS_STAR, tables)
    assert tables["orders"].count() == 2
    assert denormalize(ORDERS_STAR, tables, allow_fan_out=True).count() == 4
