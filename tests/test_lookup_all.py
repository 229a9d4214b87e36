"""All lookups in one join: results like one after another, two shuffles whatever their number."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators.dims import frequent_shares
from starmart.operators.keys import hash_key
from starmart.operators.lookup_all import lookup_all
from starmart.plans.star import build_star, resolve_keys
from starmart.sources.store import workspace
from starmart.spec import Dimension, Reference, Star, columns

STAR = Star(
    dimensions=tuple(Dimension(f"d{i}", f"k{i}", columns(f"a{i} bigint, b{i} string")) for i in range(4)),
    fact=Dimension(
        "f", "id", columns("id bigint, note string"), natural_key=True, references=tuple(Reference(f"k{i}", f"d{i}") for i in range(4))
    ),
)


def source(spark, n=6_000):
    """The first dimension has one tuple in half of all rows, the second NULLs, the others many tuples."""
    made = {"id": F.col("id"), "note": F.when(F.col("id") % 5 > 0, F.concat(F.lit("n"), F.col("id")))}
    for i in range(4):
        a = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 300) if i == 0 else F.col("id") % (200 * i)
        made |= {f"a{i}": a.cast("bigint"), f"b{i}": F.when(F.col("id") % (i + 2) > 0, F.concat(F.lit("t"), F.col("id") % 3))}
    return spark.range(n).select(*[c.alias(name) for name, c in made.items()])


@pytest.fixture(scope="module")
def loaded(spark):
    wide = workspace(spark).save("wide", source(spark))
    tables = build_star(wide, STAR, key_kind="dense", staged=True)
    return wide, tables


KINDS = {f"d{i}": "dense" for i in range(4)}


@pytest.mark.parametrize("threshold", ["-1", "10m"])
@pytest.mark.parametrize("hot_share", [None, 0.001, 0.3])
def test_equals_the_chain(spark, loaded, conf, threshold, hot_share):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    wide, tables = loaded
    facts = resolve_keys(wide, STAR, "f", tables, KINDS, hot_share=hot_share, one_shuffle=True)
    assert facts.columns == tables["f"].columns
    assert rows(facts) == rows(tables["f"])


def test_null_never_matches_on_request(spark, loaded):
    wide, tables = loaded
    both = [resolve_keys(wide, STAR, "f", tables, KINDS, null_safe=False, one_shuffle=o) for o in (False, True)]
    assert rows(both[0]) == rows(both[1])
    assert both[1].where("k0 IS NULL").count() > 0


def exchanges_of_rows(df):
    """Shuffles of the fact's rows: those that stand above the numbering of rows."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    numbered = next(i for i, line in enumerate(plan) if "monotonically_increasing_id" in line)
    depth = next(i for i, c in enumerate(plan[numbered]) if c.isalpha())
    count = 0
    for line in reversed(plan[:numbered]):
        at = next(i for i, c in enumerate(line) if c.isalpha())
        if at < depth:
            depth = at
            count += "Exchange hashpartitioning" in line
    return count


@pytest.mark.parametrize("k", [1, 2, 4])
def test_two_shuffles(spark, loaded, conf, k):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    wide, tables = loaded
    names = [f"k{i}" for i in range(k)]
    hashes = {n: hash_key([f"a{n[1]}", f"b{n[1]}"]) for n in names}
    dims = {n: tables[f"d{n[1]}"].select(hashes[n].alias("h"), n) for n in names}
    hot = frequent_shares(wide, {n: [hashes[n]] for n in names}, 0.01)
    found = lookup_all(wide, {n: (hashes[n], dims[n]) for n in names}, ["id", "note"])
    assert exchanges_of_rows(found) == 2
    salted = lookup_all(wide, {n: (hashes[n], dims[n]) for n in names}, ["id", "note"], hot)
    assert exchanges_of_rows(salted) == 2
    assert rows(found) == rows(salted) == rows(tables["f"].select("id", "note", *names))


def test_hot_group_is_dealt_to_many_parts(spark, loaded, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    wide, tables = loaded
    hashed = hash_key(["a0", "b0"])
    hot = {"k0": frequent_shares(wide, {"k0": ["a0", "b0"]}, 0.1)["k0"]}
    assert hot["k0"]
    from starmart.operators.lookup_all import _with_parts

    parts = _with_parts(wide.select(F.lit(0).alias("_ref"), hashed.alias("_hash")), hot, ["k0"])
    most = parts.groupBy("_hash", "_parts").count().select(F.max(F.col("count") / F.col("_parts"))).first()[0]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert most <= wide.count() / tasks


def test_repeated_and_missing(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (None, 6), (2, None)], "id long, h long")
    dim = spark.createDataFrame([(5, 50)], "anything long, else long")
    found = lookup_all(df, {"k": (F.col("h"), dim), "m": (F.col("h") + 1, dim)}, ["id"])
    assert rows(found) == rows(spark.createDataFrame([(1, 50, None), (1, 50, None), (None, None, None), (2, None, None)], "id long, k long, m long"))
    assert lookup_all(df.where("false"), {"k": (F.col("h"), dim)}, ["id"]).count() == 0
    assert rows(lookup_all(df, {}, ["id"])) == rows(df.select("id"))


def test_counted_dimensions_decide_about_the_broadcast(spark, loaded, conf):
    """Each dimension's files are under the threshold, the rows of all together are over it."""
    conf("spark.sql.autoBroadcastJoinThreshold", "10000")
    wide, tables = loaded
    hashes = {n: hash_key([f"a{i}", f"b{i}"]) for i, n in enumerate(f"k{i}" for i in range(4))}
    dims = {n: tables[f"d{i}"].select(hash_key([f"a{i}", f"b{i}"]).alias("h"), n).where("h IS NOT NULL") for i, n in enumerate(hashes)}
    lookups = {n: (hashes[n], dims[n]) for n in hashes}
    few, many = (lookup_all(wide, lookups, ["id"], counted=c) for c in (1, 100_000))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (few, many)]
    assert "SortMergeJoin" in plans[1] and "Broadcast" not in plans[1]
    assert rows(few) == rows(many)
