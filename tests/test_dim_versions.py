"""One version of a key, and all of them with their ranges."""

import random

import pytest

from conftest import rows
from listing_rows import SECOND_HOST_VERSION, VARIATIONS, raw_rows
from starmart.operators.dim_versions import latest_versions, version_ranges
from starmart.plans.listings import LISTINGS_STAR, load_listings
from starmart.plans.star import denormalize

SCHEMA = "k int, a string, b double, at int, id int"


def data(n=400):
    rng = random.Random(2)
    return [
        (rng.choice([None, 1, 2, 3, 3, 3, 3]), rng.choice([None, "x", "y"]), rng.choice([None, 0.5, 1.5]), rng.choice([None, *range(12)]), rng.randrange(5))
        for _ in range(n)
    ]


def nulls_first(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def test_latest(spark):
    got = latest_versions(spark.createDataFrame(data(), SCHEMA), "k", ["k", "a", "b"], ["at", "id"])
    want = {}
    for k, a, b, at, id_ in data():
        want[k] = max(want.get(k, ()), (nulls_first((at, id_)), nulls_first((a, b)), (a, b)), key=lambda v: v[:2])
    assert rows(got) == sorted(((k, *v[2]) for k, v in want.items()), key=lambda r: [(v is not None, str(v)) for v in r])


def test_ranges(spark):
    got = version_ranges(spark.createDataFrame(data(), SCHEMA), "k", ["a", "b"], "at", ["id"])
    by_time = {}
    for k, a, b, at, id_ in data():
        if at is not None:
            new = (nulls_first((id_,)), nulls_first((a, b)), (a, b))
            by_time[k, at] = max(by_time.get((k, at), new), new, key=lambda v: v[:2])
    want = []
    for k in {k for k, _ in by_time}:
        spans = []
        for at in sorted(at for key, at in by_time if key == k):
            version = by_time[k, at][2]
            if not spans or spans[-1][0] != version:
                spans.append((version, at))
        ends = [at for _, at in spans[1:]] + [None]
        want += [(k, *version, at, end) for (version, at), end in zip(spans, ends, strict=True)]
    assert rows(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


def test_order_of_rows_does_not_matter(spark):
    df = spark.createDataFrame(data(), SCHEMA)
    for change in (df.repartition(7), df.repartition(3, "b"), df.union(df)):
        assert rows(latest_versions(change, "k", ["a", "b"], ["at"])) == rows(latest_versions(df, "k", ["a", "b"], ["at"]))


def test_join_back_does_not_multiply(spark):
    raw = raw_rows(spark, VARIATIONS, SECOND_HOST_VERSION)
    with pytest.raises(ValueError):
        denormalize(LISTINGS_STAR, load_listings(raw))
    tables = load_listings(raw, latest={"host": ["last_scraped", "listing_id"]})
    assert tables["host"].count() == tables["host"].select("host_id").distinct().count()
    wide = denormalize(LISTINGS_STAR, tables)
    assert wide.count() == raw.count()
    (about,) = {r.host_about for r in wide.where("host_id = 7").collect()}
    assert about == "Hello again"  # the greatest listing of the same day


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert latest_versions(empty, "k", ["a"], ["at"]).count() == 0
    assert version_ranges(empty, "k", ["a"], "at").count() == 0
