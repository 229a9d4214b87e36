import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators import dims
from starmart.operators.dims import extract_dim, frequent_tuples, save_dim
from starmart.operators.keys import has_duplicates, hash_key
from starmart.sources.store import workspace


@pytest.fixture(scope="module")
def source(spark):
    return spark.range(20_000).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 500).alias("a"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 40)).alias("b"),
    )


def expected(source):
    tuples = {(r.a, r.b) for r in source.collect()}
    order = sorted(tuples, key=lambda t: [(v is not None, v if v is not None else 0) for v in t])
    return [(i, *t) for i, t in enumerate(order)]


def test_dense_is_rank(source):
    got = sorted(tuple(r) for r in extract_dim(source, ["a", "b"], "k").collect())
    assert got == expected(source)


@pytest.mark.parametrize("partitions, adaptive", [(1, "true"), (13, "false"), (64, "true")])
def test_keys_do_not_depend_on_partitions(source, conf, partitions, adaptive):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.enabled", adaptive)
    got = sorted(tuple(r) for r in extract_dim(source, ["a", "b"], "k").collect())
    assert got == expected(source)


def test_hash_marks_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("", None)], "x string, y string")
    assert df.select(hash_key(["x", "y"])).distinct().count() == 4


@pytest.mark.parametrize("kind", ["hash", "monotonic", "dense"])
def test_keys_are_unique(source, kind):
    dim = extract_dim(source, ["a", "b"], "k", kind)
    assert not has_duplicates(dim, "k")
    assert dim.count() == source.distinct().count()
    assert rows(dim) == rows(dim)


def test_unknown_kind(source):
    with pytest.raises(ValueError):
        extract_dim(source, ["a"], "k", "uuid")


def test_colliding_hashes_become_dense(spark, source, monkeypatch):
    monkeypatch.setattr(dims, "hash_key", lambda cols: F.col(cols[0]).isNull().cast("bigint"))
    saved, kind = save_dim(source, "d", ["a", "b"], "k", "hash", workspace(spark))
    assert kind == "dense"
    assert sorted(tuple(r) for r in saved.collect()) == expected(source)


def test_empty_source(spark):
    empty = spark.createDataFrame([], "a int, b string")
    for kind in ("hash", "dense", "monotonic"):
        assert extract_dim(empty, ["a", "b"], "k", kind).count() == 0
    assert frequent_tuples(empty, {"t": ["a"]}) == {"t": []}


def test_frequent_tuples(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("x"))
    found = frequent_tuples(df, {"x": ["x"]})["x"]
    (hot,) = df.where("x IS NULL").select(hash_key(["x"])).distinct().collect()
    assert found == [hot[0]]
