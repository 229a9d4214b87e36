"""Typing in one pass: values, rejects with their rows, counts."""

import datetime
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators.casting import cast_rejects, cast_schema
from starmart.operators.quarantine import Counting, load_typed
from starmart.sources.store import workspace
from starmart.spec import Column, columns

SCHEMA = (Column("k", "int", nullable=False), *columns("n int, d decimal(3,2), day date, s varchar(3), w int"))
DATA = [
    ("1", "4.0", "1.239", "2024-01-02", "abc", 5),
    ("2", "N/A", "12.34", "2024-13-02", "abcd", 5_000_000_000),
    ("3", None, None, None, None, None),
    ("x", "99999999999", "..", "never", "", 7),
    (None, "", " ", "", "é€😀", None),
    ("1", "4.0", "1.239", "2024-01-02", "abc", 5),
]
TYPES = "k string, n string, d string, day string, s string, w long"


@pytest.fixture
def source(spark):
    return spark.createDataFrame(DATA, TYPES).withColumn("extra", F.lit("kept"))


def test_values_rejects_and_counts(spark, source):
    load = load_typed(source, SCHEMA, "k", workspace(spark), "t")
    assert load.clean.columns == source.columns
    assert rows(load.clean) == rows(cast_schema(source, SCHEMA))
    assert load.n_rows == 6
    assert sorted(map(tuple, load.quarantine.collect()), key=str) == sorted(
        [
            ("2", "n", "N/A", "not a number"), ("2", "d", "12.34", "out of range"), ("2", "day", "2024-13-02", "not a date"),
            ("2", "s", "abcd", "too wide"), ("2", "w", "5000000000", "out of range"),
            ("x", "k", "x", "not a number"), ("x", "n", "99999999999", "out of range"), ("x", "d", "..", "not a number"),
            ("x", "day", "never", "not a date"),
            (None, "k", None, "missing"), (None, "n", "", "not a number"), (None, "d", " ", "not a number"), (None, "day", "", "not a date"),
        ],
        key=str,
    )
    counted = {r.column_name: (r.n_values, r.n_rejects) for r in load.counts.collect()}
    lost = {r.column_name: (r.n_values, r.n_rejects) for r in cast_rejects(source, SCHEMA).collect()}
    assert counted == lost | {"k": (5, 2), "s": (5, 1)}


def test_one_scan_of_the_source(spark, source):
    """Every row of the source is read once, for copy, quarantine and counts together."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    load = load_typed(source.mapInArrow(count, source.schema), SCHEMA, "k", workspace(spark), "t")
    assert load.clean.count() == 6 and load.quarantine.count() == 13 and load.counts.count() == 6
    assert read.value == 6


def test_counts_are_of_many_tasks(spark):
    many = spark.range(10_000, numPartitions=9).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 10 == 0, "bad").otherwise("1").alias("n")
    )
    load = load_typed(many, columns("k int, n int"), "k", workspace(spark), "t")
    assert rows(load.counts) == rows(spark.createDataFrame([("k", "int", 10_000, 0), ("n", "int", 10_000, 1_000)], load.counts.schema))
    assert load.quarantine.count() == 1_000 and load.n_rows == 10_000


def test_odd_sources(spark, source):
    empty = load_typed(source.where("false"), SCHEMA, "k", workspace(spark), "t")
    assert (empty.n_rows, empty.clean.count(), empty.quarantine.count()) == (0, 0, 0)
    assert {(r.n_values, r.n_rejects) for r in empty.counts.collect()} == {(0, 0)}
    nothing = load_typed(source, (), "k", workspace(spark), "t")
    assert rows(nothing.clean) == rows(source) and nothing.quarantine.count() == 0
    with pytest.raises(ValueError, match="absent"):
        load_typed(source, columns("nope int"), "k", workspace(spark), "t")
    typed = spark.createDataFrame([(1, Dec("1.5"), datetime.date(2024, 1, 1))], "k int, d decimal(3,2), day date")
    assert rows(load_typed(typed, columns("k int, d decimal(3,2), day date"), "k", workspace(spark), "t").clean) == rows(typed)


def test_tables_are_counted_while_written(spark, source):
    store = Counting(workspace(spark))
    saved = store.save("a", source)
    store.save("b", source.where("k = '1'").repartition(5))
    assert store.rows == {"a": 6, "b": 2}
    assert rows(store.load(spark, "a")) == rows(saved)
