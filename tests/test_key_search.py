"""The search for minimal keys against all subsets."""

import datetime
import random
from itertools import combinations

import pytest

from starmart.operators import key_search
from starmart.operators.key_search import AgreeSets, minimal_keys
from starmart.plans.listings import LISTINGS_STAR


def brute_force(rows, names, width):
    keys = []
    for size in range(1, width + 1):
        for subset in combinations(range(len(names)), size):
            if any(set(k) <= set(subset) for k in keys):
                continue
            if len({tuple(r[i] for i in subset) for r in rows}) == len(rows):
                keys.append(subset)
    return [tuple(names[i] for i in k) for k in keys]


def table(rng, n):
    rows = {
        (rng.randrange(12), rng.choice([None, "a", "b", "x" * 100, "x" * 99 + "y"]), rng.choice([None, 0.5, 1.5]),
         rng.choice([True, False]), rng.randrange(n), datetime.date(2024, 1, 1 + rng.randrange(20)))
        for _ in range(n)
    }
    return sorted(rows, key=str)


SCHEMA = "a int, b string, c double, d boolean, e long, f date"


@pytest.mark.parametrize("seed, n", [(1, 8), (2, 40), (3, 300)])
def test_equals_all_subsets(spark, seed, n):
    rows = table(random.Random(seed), n)
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, SCHEMA)
    assert minimal_keys(df, width=4) == brute_force(rows, names, 4)
    # The sample only saves checks.
    assert minimal_keys(df, width=3, sample_rows=1) == brute_force(rows, names, 3)


def test_sample_saves_checks(spark, monkeypatch):
    rows = table(random.Random(3), 300)
    checked = []
    witness = key_search._witness
    monkeypatch.setattr(key_search, "_witness", lambda df, names, subset: checked.append(subset) or witness(df, names, subset))
    found = minimal_keys(spark.createDataFrame(rows, SCHEMA), width=4)
    assert len(checked) == len(set(checked))
    # The sample holds the whole table here, so that only keys are left to be checked.
    assert set(checked) == set(found)
    checked.clear()
    assert minimal_keys(spark.createDataFrame(rows, SCHEMA), width=4, sample_rows=1) == found
    # Each failed check refutes further sets: fewer checks than sets that are no keys.
    assert len(found) < len(checked) < len([s for k in range(1, 5) for s in combinations("abcdef", k)])


def test_every_listing_dimension(spark):
    from listing_rows import raw_rows

    from starmart.operators.dims import distinct_rows
    from starmart.plans.listings import clean_listings

    rng = random.Random(6)
    numbers = ["minimum_nights", "maximum_nights", "host_listings_count"]
    texts = ["beds", "availability_30", "review_scores_rating", "neighbourhood", "price"]
    varied = {i: {c: rng.randrange(4) for c in numbers} | {c: str(rng.randrange(5)) for c in texts} for i in range(30)}
    clean = clean_listings(raw_rows(spark, varied)).cache()
    for spec in LISTINGS_STAR.dimensions:
        if not spec.natural_key:
            rows = distinct_rows(clean, spec.attribute_names)
            data = [tuple(r) for r in rows.collect()]
            assert minimal_keys(rows, width=2) == brute_force(data, spec.attribute_names, 2)
    clean.unpersist()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert minimal_keys(empty) == [("a",), ("b",)]
    copies = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert minimal_keys(copies) == []
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3), (float("nan"), 4)], "a double, b int")
    assert minimal_keys(zeros) == [("b",)]
    maps = spark.createDataFrame([({"x": 1}, [1, 2]), ({"x": 1}, [1, 3])], "m map<string,int>, a array<int>")
    assert minimal_keys(maps) == [("a",)]
    nested = spark.createDataFrame([((1, [2]), 1, 1), ((1, [2]), 2, 1), ((1, [3]), 2, 1)], "s struct<x:int,y:array<int>>, b int, c int")
    assert minimal_keys(nested) == minimal_keys(nested, sample_rows=1) == [("s", "b")]


def test_agree_sets_keep_the_largest():
    seen = AgreeSets()
    seen.add([0b001, 0b011])
    seen.add([0b110, 0b010])
    assert sorted(seen.largest) == [0b011, 0b110]
    assert seen.refute(0b010) and not seen.refute(0b101)


def test_many_columns():
    rows = [[str(i % (c + 1)) for c in range(70)] for i in range(3)]
    found = set(key_search._agreements(rows))
    want = {sum(1 << c for c in range(70) if a[c] == b[c]) for a, b in combinations(rows, 2)}
    assert found - {0} == want - {0}
