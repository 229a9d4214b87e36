"""Keys of hashes too short for their table."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators import collisions
from starmart.operators.dims import extract_dim, save_settled_dim
from starmart.plans.star import build_star, denormalize
from starmart.sources.store import workspace
from starmart.spec import Dimension, Reference, Star, columns

STAR = Star(
    dimensions=(Dimension("d", "k", columns("a bigint, b string")),),
    fact=Dimension("f", "id", columns("id bigint"), natural_key=True, references=(Reference("k", "d"),)),
)


@pytest.fixture(scope="module")
def source(spark):
    return spark.range(20_000).select(
        "id",
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 1500).alias("a"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 40)).alias("b"),
    )


def keys(df):
    return {(r.a, r.b): r.k for r in df.collect()}


@pytest.mark.parametrize("bits", [20, 15])
def test_only_colliding_tuples_are_moved(spark, source, bits):
    plain = keys(extract_dim(source, ["a", "b"], "k", "hash", bits=bits))
    saved, kind, side = save_settled_dim(source, "d", ["a", "b"], "k", "hash", workspace(spark), bits=bits)
    got, moved = keys(saved), {(r.a, r.b): (r["_hash"], r.k) for r in side.collect()}
    assert kind == "hash" and moved and len(got) == len(plain)
    assert len(set(got.values())) == len(got)
    assert {t: k for t, k in got.items() if t not in moved} == {t: k for t, k in plain.items() if t not in moved}
    assert {t: (plain[t], got[t]) for t in moved} == moved
    # Of the tuples with one hash exactly one keeps it, the first in attribute order.
    by_hash = {}
    for t, h in plain.items():
        by_hash.setdefault(h, []).append(t)
    order = lambda t: [(v is not None, v if v is not None else 0) for v in t]
    assert set(moved) == {t for ts in by_hash.values() for t in sorted(ts, key=order)[1:]}


def test_second_load_has_the_same_keys(spark, source):
    first, second = (save_settled_dim(source.repartition(n), "d", ["a", "b"], "k", "hash", workspace(spark), bits=18)[0] for n in (3, 11))
    assert keys(first) == keys(second)


def test_more_rows_leave_other_keys(spark, source):
    """A later load with further tuples moves only those that the new ones collide with."""
    old = keys(save_settled_dim(source.where("id < 12000"), "d", ["a", "b"], "k", "hash", workspace(spark), bits=20)[0])
    saved, _, side = save_settled_dim(source, "d", ["a", "b"], "k", "hash", workspace(spark), bits=20)
    new, plain = keys(saved), keys(extract_dim(source, ["a", "b"], "k", "hash", bits=20))
    shared = {r["_hash"] for r in side.collect()}
    assert {t for t in old if new[t] != old[t]} <= {t for t in old if plain[t] in shared}


def test_fact_finds_moved_tuples(spark, source):
    store = workspace(spark)
    tables = build_star(source, STAR, store, key_bits=16)
    assert store.load(spark, "d_collisions").count() > 20
    assert rows(denormalize(STAR, tables).select("id", "a", "b")) == rows(source.select("id", "a", "b"))


def test_side_table_is_broadcast_and_no_fact_is_shuffled(spark, source):
    from starmart.plans.star import resolve_keys

    staged = workspace(spark).save("s", source)
    saved, _, side = save_settled_dim(staged, "d", ["a", "b"], "k", "hash", workspace(spark), bits=16)
    facts = resolve_keys(staged, STAR, "f", {"d": saved}, {"d": "hash"}, sides={"d": side}, key_bits=16)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_no_collision_no_join(spark, source):
    saved, kind, side = save_settled_dim(source, "d", ["a", "b"], "k", "hash", workspace(spark))
    assert (kind, side) == ("hash", None)


def test_too_many_collisions_become_dense(spark, source):
    saved, kind, side = save_settled_dim(source, "d", ["a", "b"], "k", "hash", workspace(spark), bits=6)
    assert (kind, side) == ("dense", None)
    assert sorted(keys(saved).values()) == list(range(saved.count()))


def test_bound_of_the_side_table(spark, source, monkeypatch):
    monkeypatch.setattr(collisions, "MOST_COLLIDING", 10)
    assert save_settled_dim(source, "d", ["a", "b"], "k", "hash", workspace(spark), bits=16)[1] == "dense"


def test_bits(source):
    for bits in (0, 65):
        with pytest.raises(ValueError):
            extract_dim(source, ["a"], "k", "hash", bits=bits)
