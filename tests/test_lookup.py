import pytest
from pyspark.sql import functions as F

from starmart.operators.dims import extract_dim, frequent_tuples
from starmart.operators.lookup import FanOutError, fan_out, lookup, lookup_large, may_shuffle


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one tuple, and that one has a NULL."""
    hot = F.col("id") % 3 == 0
    return spark.range(6_000).select(
        "id",
        F.when(~hot, F.col("id") % 50).alias("a"),
        F.when(hot, "hot").when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id") % 11)).alias("b"),
    )


def brute(facts, dim, how="left", null_safe=True):
    keys = {(r.a, r.b): r.k for r in dim.collect()}
    out = []
    for r in facts.collect():
        found = keys.get((r.a, r.b)) if null_safe or None not in (r.a, r.b) else None
        if found is not None or how == "left":
            out.append((r.id, found))
    return sorted(out)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("split", [True, False])
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup(facts, conf, how, null_safe, split, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    dim = extract_dim(facts, ["a", "b"], "k").where("k % 4 > 0")
    hot = frequent_tuples(facts, {"t": ["a", "b"]}, share=0.01)["t"] if split else ()
    assert bool(hot) == split
    got = lookup(facts, dim, ["a", "b"], "k", how=how, null_safe=null_safe, hot=hot, spread_by=["id"])
    assert got.columns == ["id", "a", "b", "k"]
    assert sorted((r.id, r.k) for r in got.collect()) == brute(facts, dim, how, null_safe)


def test_hot_group_is_spread(facts, conf):
    """No task of the shuffled join gets the whole hot group."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    dim = extract_dim(facts, ["a", "b"], "k")
    hot = frequent_tuples(facts, {"t": ["a", "b"]})["t"]
    joined = lookup(facts, dim, ["a", "b"], "k", hot=hot, spread_by=["id"])
    per_task = joined.where("b = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 8
    assert max(r["count"] for r in per_task) < 2_000 / 3


def test_fan_out(facts):
    dim = extract_dim(facts, ["a", "b"], "k")
    with pytest.raises(FanOutError):
        lookup(facts, dim, ["a"], "k", check_unique=True)
    many = lookup(facts, dim, ["a"], "k", check_unique=True, allow_fan_out=True)
    counted = fan_out(facts, dim, ["a"]).agg(F.sum("joined_rows"), F.sum("left_rows")).first()
    assert tuple(counted) == (many.count(), 6_000)


def test_bad_arguments(facts):
    dim = extract_dim(facts, ["a"], "k", "hash")
    with pytest.raises(ValueError):
        lookup(facts, dim, ["a"], "k", how="full")
    with pytest.raises(ValueError):
        lookup(facts, dim, ["a"], "k", hot=[1])


def test_counted_rows_decide_about_the_broadcast(spark, conf, tmp_path):
    """Keys compress to far less than a join holds of them: files under the threshold, rows over it."""
    conf("spark.sql.autoBroadcastJoinThreshold", "200000")
    n = 20_000
    spark.range(n).select("id", (F.col("id") % 7).alias("k"), F.lit("x" * 200).alias("text")).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim")).select("id", "k")
    facts = spark.range(3 * n).withColumn("row", F.col("id") + 0)
    assert not may_shuffle(dim) and may_shuffle(dim, n) and not may_shuffle(dim, 1_000)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Broadcast" in plan(lookup(facts, dim, ["id"], "k", rows=1_000))
    large = lookup(facts, dim, ["id"], "k", rows=n)
    assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    assert "SortMergeJoin" in plan(lookup_large(facts, dim, ["id"], "k", spread_by=["row"]))
    assert large.where("k = id % 7").count() == n and large.where("k IS NULL").count() == 2 * n
    # Hot groups are met by broadcast, the rest is shuffled.
    hot = frequent_tuples(facts, {"t": ["id"]}, share=1e-5)["t"][:3]
    apart = lookup(facts, dim, ["id"], "k", hot=hot, spread_by=["row"], rows=n)
    assert "SortMergeJoin" in plan(apart)
    assert sorted(apart.collect()) == sorted(large.collect())
