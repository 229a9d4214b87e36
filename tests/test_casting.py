from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators.casting import cast_rejects, cast_schema, fill_nulls
from starmart.operators.columns import key_first, rename
from starmart.spec import columns

SCHEMA = columns("n int, d decimal(3,2), s string, day date")


@pytest.fixture
def messy(spark):
    return spark.createDataFrame(
        [
            ("4", "1.234", "x", "2023-01-02"),
            ("4.0", "12.34", None, "2023-13-02"),
            (" 7 ", "", "y", None),
            ("4.9999999999", "N/A", "z", ""),
            ("99999999999", ".5", "", "x"),
            ("4.x", "-9.99", "", "2023-1-2"),
            (None, None, None, None),
        ],
        "n string, d string, s string, day string",
    )


def test_cast(messy):
    got = cast_schema(messy, SCHEMA)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "decimal(3,2)", "string", "date"]
    assert [r.n for r in got.collect()] == [4, 4, 7, 4, None, None, None]
    assert [r.d for r in got.collect()] == [
        Dec("1.23"), None, None, None, Dec("0.50"), Dec("-9.99"), None,
    ]
    assert [str(r.day) for r in got.collect()][:3] == ["2023-01-02", "None", "None"]


def test_cast_keeps_or_drops_others(messy):
    part = columns("d decimal(3,2)")
    assert cast_schema(messy, part).columns == ["n", "d", "s", "day"]
    assert cast_schema(messy, part, keep_others=False).columns == ["d"]
    with pytest.raises(ValueError, match="absent"):
        cast_schema(messy, columns("nope int"))


def test_averages_round_to_whole_numbers(spark):
    df = spark.createDataFrame([("2.5",), ("3.4",)], "a string")
    assert [r.a for r in cast_schema(df, columns("a numeric")).collect()] == [3, 3]


def test_rejects(messy):
    assert rows(cast_rejects(messy, SCHEMA)) == [
        ("d", "decimal(3,2)", 6, 3),
        ("day", "date", 5, 3),
        ("n", "int", 6, 2),
        ("s", "string", 5, 0),
    ]


def test_fill(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, d decimal(3,2), s string")
    assert fill_nulls(df, {"n": -1, "d": -1, "s": "N/A"}).first() == (-1, Dec("-1.00"), "N/A")


@pytest.mark.parametrize(
    "fills",
    [{"day": "00-00-00"}, {"n": "x"}, {"n": 2**31}, {"d": 10}, {"d": 0.125}, {"s": 1}, {"no": 1}],
)
def test_fill_refuses_what_does_not_fit(spark, fills):
    df = spark.createDataFrame([], "n int, d decimal(3,2), s string, day date")
    with pytest.raises(ValueError):
        fill_nulls(df, fills)


def test_rename_and_key_first(spark):
    df = spark.range(1).select(F.col("id").alias("a"), F.lit(1).alias("b"))
    assert rename(df, {"a": "x"}).columns == ["x", "b"]
    assert key_first(df, "b").columns == ["b", "a"]
    for names in ({"nope": "x"}, {"a": "b"}):
        with pytest.raises(ValueError):
            rename(df, names)


TEXTS = [
    "4", "-4", "+4", ".5", "-.5", "+.5", "0.5", "5.", "-5.", " 4 ", "\t4.0\n", "\x004", "4\x7f", "\x7f.5", "\u00854", "4\u0085", " 4",
    "N/A", "$5", "(5)", "", " ", ".", "-", "+", "-.", "1.2.3", "4.x", "4.5e1", "1e3", "1,200", "12 3", "2147483648", "-2147483648.9",
    "٣", "Ä4", "4.0 \x01", ". 5", "- 5", "NaN", "Infinity", "0x1F", "5L", "99999999999999999999.5", "4.9999999999\n",
]


def test_integers_as_the_published_cast(spark, conf):
    """With ANSI mode off Spark's own cast cuts decimals off; a point alone is no number here."""
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: (r.n, r.b) for r in cast_schema(df.select("t", F.col("t").alias("n"), F.col("t").alias("b")), columns("n int, b bigint")).collect()}
    conf("spark.sql.ansi.enabled", "false")
    want = {r.t: (r.n, r.b) for r in df.select("t", F.col("t").cast("int").alias("n"), F.col("t").cast("bigint").alias("b")).collect()}
    assert got == want | {t: (None, None) for t in (".", "-.")}


def test_decimals_as_try_cast(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").withColumn("d", F.col("t"))
    got = {r.t: r.d for r in cast_schema(df, columns("d decimal(12,3)")).collect()}
    assert got == {r.t: r.d for r in df.select("t", F.col("t").try_cast("decimal(12,3)").alias("d")).collect()}
    assert got[".5"] == Dec("0.500") and got["\u00854"] is None
