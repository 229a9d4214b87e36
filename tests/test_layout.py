"""A star in buckets: joined back without a shuffle, hot keys apart."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.plans.layout import BucketedStar
from starmart.plans.star import build_star, denormalize
from starmart.sources import catalog
from starmart.sources.store import workspace
from starmart.spec import Dimension, Reference, Star, columns

STAR = Star(
    dimensions=(
        Dimension("big", "bk", columns("bk bigint, name string"), natural_key=True, references=(Reference("zk", "zone"),)),
        Dimension("zone", "zk", columns("z string")),
        Dimension("small", "sk", columns("s string")),
    ),
    fact=Dimension("f", "id", columns("id bigint"), natural_key=True, references=(Reference("sk", "small"), Reference("bk", "big"))),
)


@pytest.fixture(scope="module")
def wide(spark):
    """A third of the rows has one key, some have none."""
    bk = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 900)
    made = spark.range(6_000).select("id", bk.cast("bigint").alias("bk"), F.concat(F.lit("s"), F.col("id") % 4).alias("s"))
    name = F.concat(F.lit("n"), "bk")
    return workspace(spark).save("wide", made.select("*", name.alias("name"), F.concat(F.lit("z"), F.col("bk") % 5).alias("z")))


@pytest.fixture
def layout(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, str(tmp_path / "warehouse"))
    yield BucketedStar(STAR, spark, name, "big", 4)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_joined_back(spark, wide, layout):
    tables = build_star(wide, STAR)
    layout.save(tables)
    want = rows(denormalize(STAR, tables))
    assert rows(layout.denormalize()) == want
    assert rows(denormalize(STAR, layout.tables())) == want
    hot = spark.table(layout.name("f_hot"))
    assert hot.where("bk = 7").count() == 2_007 and spark.table(layout.name("f")).where("bk = 7").count() == 0
    # A second load takes the place of the first.
    layout.save(build_star(wide.where("id < 1000"), STAR))
    assert layout.denormalize().count() == 1_000


def test_no_shuffle_of_the_largest_join(spark, wide, layout, conf):
    layout.save(build_star(wide, STAR))
    conf("spark.sql.adaptive.enabled", "false")
    dims = {n: spark.table(layout.name(n)) for n in STAR.write_order}
    plan = denormalize(STAR, dims, bucketed="big")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan, plan
    assert plan.count("SelectedBucketsCount: 4 out of 4") >= 2


def test_no_hot_keys(spark, wide, layout):
    tables = build_star(wide.where("bk <> 7"), STAR)
    layout.save(tables)
    assert spark.table(layout.name("f_hot")).count() == 0
    assert rows(layout.denormalize()) == rows(denormalize(STAR, tables))


def test_reference_must_be_one(spark):
    with pytest.raises(ValueError, match="0 references"):
        BucketedStar(STAR, spark, "d", "zone", 4)
