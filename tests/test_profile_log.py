"""Profiles that add up over loads, and profiles of odd tables."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators.profile import profile
from starmart.operators.profile_log import ERROR, ProfileLog, merged, sketch_profile


def source(spark, low, high):
    return spark.range(low, high).select(
        "id", (F.col("id") % 13).alias("digit"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("t"), F.col("id") % 3000)).alias("text"),
        (F.col("id") % 50 / 4).alias("x"), F.array(F.col("id") % 5, F.lit(1)).alias("list"), F.lit(None).cast("date").alias("none"),
    )


@pytest.fixture
def log(spark, tmp_path):
    return ProfileLog(spark, str(tmp_path / "profiles"))


def check(got, df):
    exact = {r.column_name: r for r in profile(df).collect()}
    found = {r.column_name: r for r in got.collect()}
    assert found.keys() == exact.keys()
    for name, want in exact.items():
        assert (found[name].type, found[name].n_rows, found[name].n_non_null) == (want.type, want.n_rows, want.n_non_null)
        assert abs(found[name].n_distinct - want.n_distinct) <= 3 * ERROR * want.n_distinct
    assert found["text"].max_width == df.agg(F.max(F.length("text"))).first()[0] and found["id"].max_width is None


def test_loads_add_up(spark, log):
    assert log.profile().count() == 0
    parts = {"a": source(spark, 0, 8_000), "b": source(spark, 5_000, 20_000), "c": source(spark, 0, 10)}
    for name, df in parts.items():
        log.add(name, df)
    check(log.profile(), parts["a"].union(parts["b"]).union(parts["c"]))
    check(log.profile("a", "c"), parts["a"].union(parts["c"]))
    check(log.profile("b"), parts["b"])


def test_a_load_added_again_is_replaced(spark, log):
    log.add("a", source(spark, 0, 900))
    log.add("a", source(spark, 0, 500))
    check(log.profile(), source(spark, 0, 500))


def test_merging_reads_no_load(spark, log):
    df = source(spark, 0, 100)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    log.add("a", df.mapInArrow(count, df.schema))
    before = read.value
    check(log.profile(), df)
    assert before == read.value == 100


def test_empty_load(spark, log):
    log.add("a", source(spark, 0, 0))
    assert {(r.n_rows, r.n_non_null, r.n_distinct) for r in log.profile().collect()} == {(0, 0, 0)}
    both = sketch_profile(source(spark, 0, 0)).union(sketch_profile(source(spark, 0, 40)))
    check(merged(both), source(spark, 0, 40))


def test_exact_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert rows(profile(empty)) == [("a", "int", 0, 0, 0), ("b", "string", 0, 0, 0)]
    assert rows(profile(empty, error=0.05)) == rows(profile(empty))


def test_zeros_inside_values_are_equal(spark):
    df = spark.createDataFrame(
        [([0.0, 1.0], (0.0, [0.0])), ([-0.0, 1.0], (-0.0, [-0.0])), ([float("nan")], None), (None, (None, [None])), ([None], (None, None))],
        "a array<double>, s struct<x:double,y:array<double>>",
    )
    got = {r.column_name: r.n_distinct for r in profile(df).collect()}
    assert got == {c: df.select(c).where(f"{c} IS NOT NULL").distinct().count() for c in ("a", "s")}
