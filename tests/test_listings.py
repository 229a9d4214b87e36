"""The listings plan on rows that each prove one rule."""

from decimal import Decimal as Dec

import pytest

from conftest import rows
from listing_rows import SECOND_HOST_VERSION, VARIATIONS, raw_rows
from starmart.operators.checks import check_star, not_in_list, row_conservation
from starmart.operators.casting import cast_rejects
from starmart.operators.lookup import FanOutError
from starmart.plans.listings import (
    AS_PUBLISHED,
    FILLS,
    LISTINGS_STAR,
    NEIGHBOURHOODS,
    PARTIAL_KEYS,
    clean_listings,
    load_listings,
    with_partial_keys,
)
from starmart.plans.star import build_star, denormalize
from starmart.spec import columns


@pytest.fixture(scope="module")
def clean(spark):
    return {r.listing_id: r for r in clean_listings(raw_rows(spark)).collect()}


def test_clean_types(spark):
    got = clean_listings(raw_rows(spark)).schema
    want = {c.name: c.spark_type for c in LISTINGS_STAR.wide_columns}
    assert {f.name: f.dataType for f in got} == want


def test_ordinary_row(clean):
    r = clean[1]
    assert (r.host_response_time, r.host_response_rate, r.daily_price) == ("H", Dec("0.97"), Dec("85.00"))
    assert (r.bathrooms, r.bathroom_desc, r.beds, r.accommodates) == (Dec("1.0"), "bath", 2, 4)
    assert (r.host_verifications, r.host_is_superhost, r.host_identity_verified) == ("110", 1, 0)


def test_texts(clean):
    assert clean[2].host_response_time == "D"
    assert clean[3].host_response_time == "D+"
    r = clean[4]
    assert (r.host_response_time, r.host_response_rate, r.host_acceptance_rate) == ("NA", -1, -1)
    assert [clean[i].host_verifications for i in (6, 7, 71)] == ["001", None, "000"]
    assert (clean[8].host_is_superhost, clean[8].host_has_profile_pic) == (0, 0)
    assert (clean[9].daily_price, clean[10].daily_price) == (Dec("1200.00"), Dec("-1.00"))
    baths = [(clean[i].bathrooms, clean[i].bathroom_desc) for i in (12, 121, 122, 123, 124)]
    assert baths == [
        (None, None),
        (Dec("0.5"), "bath"),
        (Dec("0.5"), "private bath"),
        (Dec("0.5"), "shared bath"),
        (Dec("1.5"), "shared baths"),
    ]
    assert clean[11].first_review is None and clean[11].review_scores_rating == -1
    assert clean[13].reviews_per_month == -1
    assert clean[17].name == 'Line one,\n"quoted" and more'


def test_as_published(spark):
    got = {r.listing_id: r for r in clean_listings(raw_rows(spark), AS_PUBLISHED).collect()}
    assert got[2].host_response_time == "NA"
    assert got[6].host_verifications == "101"
    assert got[9].daily_price == -1
    assert (got[123].bathrooms, got[123].bathroom_desc) == (None, "half-bath")


def test_date_sentinel_is_refused(spark):
    with pytest.raises(ValueError, match="first_review"):
        clean_listings(raw_rows(spark), fills={**FILLS, "first_review": "00-00-00"})


def test_overflow_is_counted(spark):
    watched = columns("reviews_per_month decimal(3,2)")
    assert rows(cast_rejects(raw_rows(spark), watched))[0][3] == 1


@pytest.mark.parametrize("kind, hot_share", [("hash", None), ("dense", None), ("dense", 0.001), ("monotonic", None)])
def test_star_holds_everything(spark, kind, hot_share):
    raw = raw_rows(spark)
    tables = load_listings(raw, key_kind=kind, hot_share=hot_share)
    assert list(tables) == LISTINGS_STAR.write_order
    n = len(VARIATIONS)
    assert row_conservation(raw, tables["listings"], "listing_id").first() == (n, n, n, True)
    found = {r[:3]: r[3] for r in map(tuple, check_star(LISTINGS_STAR, tables).collect()) if r[3]}
    assert found == {("listings", "text_width", "license"): 1}
    back = denormalize(LISTINGS_STAR, tables, hot_share=hot_share)
    want = clean_listings(raw)
    assert rows(back.select(*want.columns)) == rows(want)


def test_no_fan_out_and_no_orphans(spark):
    tables = load_listings(raw_rows(spark), key_kind="dense")
    fact = {r.listing_id: r for r in tables["listings"].collect()}
    assert fact[14].neighbourhood_id != fact[1].neighbourhood_id
    assert fact[15].property_id != fact[1].property_id
    assert fact[11].rev_diag_id == fact[111].rev_diag_id is not None
    assert fact[12].property_id is not None
    assert len({r.host_id for r in fact.values()}) == tables["host"].count()


def test_partial_keys(spark):
    """By fewer columns the second room type and overview would double rows."""
    star = with_partial_keys(LISTINGS_STAR, PARTIAL_KEYS)
    raw = raw_rows(spark)
    with pytest.raises(FanOutError):
        load_listings(raw, star=star)
    many = load_listings(raw, star=star, allow_fan_out=True)["listings"]
    assert many.count() > raw.count()
    with pytest.raises(FanOutError):
        load_listings(raw, star=star, key_kind="dense")
    fine = with_partial_keys(LISTINGS_STAR, {"scrapings": PARTIAL_KEYS["scrapings"]})
    for kind in ("hash", "dense"):
        fact = load_listings(raw, star=fine, key_kind=kind, null_safe=False)["listings"]
        got = {r.listing_id: r for r in fact.collect()}
        assert len(got) == fact.count() == len(VARIATIONS)
        assert got[1].scraping_id is not None
        assert got[11].rev_diag_id is None and got[12].property_id is None


def test_two_versions_of_a_host(spark):
    raw = raw_rows(spark, VARIATIONS, SECOND_HOST_VERSION)
    tables = load_listings(raw)
    found = {r[:3]: r[3] for r in map(tuple, check_star(LISTINGS_STAR, tables).collect()) if r[3]}
    assert found[("host", "primary_key", "host_id")] == 1
    assert tables["listings"].count() == raw.count()


def test_hash_keys_repeat_from_run_to_run(spark):
    first, second = (load_listings(raw_rows(spark)) for _ in range(2))
    for name in LISTINGS_STAR.write_order:
        assert rows(first[name]) == rows(second[name])


def test_neighbourhood_list(spark):
    assert len(NEIGHBOURHOODS) == 27
    known = spark.createDataFrame([(n,) for n in NEIGHBOURHOODS], "known string")
    unknown = not_in_list(raw_rows(spark), "neighbourhood_cleansed", known, "known")
    assert rows(unknown) == [("Elsewhere", 1)]


def test_staged_source_is_not_copied(spark):
    clean = clean_listings(raw_rows(spark))
    assert build_star(clean, LISTINGS_STAR, staged=True)["listings"].count() == len(VARIATIONS)


def test_same_result_without_ansi(spark, conf):
    before = rows(clean_listings(raw_rows(spark)))
    conf("spark.sql.ansi.enabled", "false")
    assert rows(clean_listings(raw_rows(spark))) == before
