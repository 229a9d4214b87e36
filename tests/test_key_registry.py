"""Keys that survive later loads."""

import uuid

import pytest
from pyspark.sql import functions as F

from starmart.operators.key_registry import KeyRegistry
from starmart.sources.store import workspace


def source(spark, low, high):
    return spark.range(low, high).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 300).alias("a"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 40)).alias("b"),
    )


@pytest.fixture
def registry(spark):
    name = f"keys_{uuid.uuid4().hex}"
    made = KeyRegistry.create(spark, name, "k", source(spark, 0, 1).schema.fields, 4, workspace(spark).path("r"))
    yield made
    made.drop()


def keys(df):
    return {(r.a, r.b): r.k for r in df.collect()}


def order(tuples):
    return sorted(tuples, key=lambda t: [(v is not None, v if v is not None else 0) for v in t])


def test_keys_stay_and_go_on(spark, registry):
    expected = {}
    for low, high in ((0, 50), (30, 400), (0, 10), (100, 2_000)):
        batch = source(spark, low, high)
        tuples = {(r.a, r.b) for r in batch.collect()}
        new = order(tuples - expected.keys())
        expected |= {t: len(expected) + i for i, t in enumerate(new)}
        assert registry.register(batch) == len(new)
        assert keys(registry.dimension(batch)) == {t: expected[t] for t in tuples}
    assert keys(registry.read()) == expected
    assert sorted(expected.values()) == list(range(len(expected)))


def test_a_load_run_twice_changes_nothing(spark, registry):
    first = keys(registry.extract_dim(source(spark, 0, 500)))
    assert registry.register(source(spark, 0, 500)) == 0
    assert keys(registry.extract_dim(source(spark, 0, 500))) == first
    # Opened anew by name.
    again = KeyRegistry(spark, registry.name, "k", ("a", "b"))
    assert keys(again.dimension(source(spark, 0, 500))) == first


def test_a_load_that_fails_registers_nothing(spark, registry):
    before = keys(registry.extract_dim(source(spark, 0, 100)))
    failing = source(spark, 0, 1_000).withColumn("a", F.when(F.col("a") == 250, F.raise_error(F.lit("broken"))).otherwise(F.col("a")))
    with pytest.raises(Exception, match="broken"):
        registry.register(failing)
    assert keys(registry.read()) == before


def test_other_types_and_empty_loads(spark, registry):
    registry.register(source(spark, 0, 50))
    narrow = source(spark, 0, 50).withColumn("a", F.col("a").cast("int"))
    assert registry.register(narrow) == 0
    assert registry.register(source(spark, 0, 50).where("false")) == 0
    assert registry.dimension(source(spark, 0, 50).where("false")).count() == 0


def test_registry_is_not_shuffled(spark, registry, conf):
    conf("spark.sql.adaptive.enabled", "false")
    registry.register(source(spark, 0, 500))
    load = source(spark, 0, 900)
    for found, exchanges in ((registry.unknown(load), 1), (registry.dimension(load), 2)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        # The load's distinct and its way into the buckets; nothing for the registry.
        assert "SelectedBucketsCount: 4 out of 4" in plan and "SortMergeJoin" in plan
        assert plan.count("Exchange") == exchanges, plan
