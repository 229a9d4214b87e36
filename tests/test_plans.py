"""The physical plans are the ones we want."""

import os

import pytest

from listing_rows import raw_rows
from starmart.operators.dims import distinct_rows
from starmart.operators.lookup import lookup
from starmart.plans.listings import LISTINGS_STAR, clean_listings, load_listings
from starmart.plans.star import build_star, denormalize, resolve_keys
from starmart.queries import QUERIES
from starmart.sources.store import FolderStore, workspace

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wide(spark):
    clean = clean_listings(raw_rows(spark))
    return workspace(spark).save("clean", clean.select(*[c.name for c in LISTINGS_STAR.wide_columns]))


def test_cleaning_is_one_projection_without_python(spark):
    text = plan(clean_listings(raw_rows(spark)))
    assert "Exchange" not in text and "Python" not in text


def test_hash_keyed_fact_needs_no_join(wide):
    kinds = {d.name: "hash" for d in LISTINGS_STAR.dimensions if not d.natural_key}
    text = plan(resolve_keys(wide, LISTINGS_STAR, "listings", {}, kinds))
    assert "Join" not in text and "Exchange" not in text


def test_dense_fact_shuffles_no_attributes(spark, wide, conf):
    """Rows go to lookups with a hash of their attributes, which are left behind."""
    star = LISTINGS_STAR
    tables = build_star(wide, star, key_kind="dense", staged=True, only=["listings"])
    assert "host_quals_diags" not in tables and "host" not in tables
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    facts = resolve_keys(wide, star, "listings", tables, {n: "dense" for n in tables})
    text = plan(facts)
    assert text.count("SortMergeJoin") == 6
    for line in text.splitlines():
        if "SortMergeJoin" in line or "Project" in line and "xxhash64" not in line:
            assert "review_scores_rating" not in line and "neighbourhood_overview" not in line
    assert sorted(facts.collect()) == sorted(tables["listings"].collect())


def test_dimension_reads_its_own_columns_and_combines_before_the_shuffle(wide):
    text = plan(distinct_rows(wide, ["scrape_id", "source"]))
    assert "ReadSchema: struct<scrape_id:bigint,source:string>" in text
    assert text.count("HashAggregate") == 2


def test_null_safe_lookup_is_a_hashable_join(wide, conf):
    attributes = LISTINGS_STAR.table("reviews_diagnostics").attribute_names
    dim = distinct_rows(wide, attributes).selectExpr("1L AS rev_diag_id", *attributes)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(lookup(wide, dim, attributes, "rev_diag_id"))
    assert "SortMergeJoin [_lh" in text and "NestedLoop" not in text


@needs_data
def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["filter_in"](spark, SF))
    assert "PushedFilters: [In(o_custkey" in text


@needs_data
@pytest.mark.parametrize(
    "name", ["clean_messy", "dim_distinct", "listings_clean", "profile_table", "fk_orphans", "candidate_key"]
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "EvalPython" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_clean_copy_has_the_columns_of_the_wanted_tables(spark, monkeypatch):
    """The fact alone needs no host but its id, and no column of the host's own dimensions."""
    saved, save = {}, FolderStore.save

    def spy(self, name, df, replace=False):
        saved.setdefault(name, df.columns)
        return save(self, name, df, replace)

    monkeypatch.setattr(FolderStore, "save", spy)
    raw = raw_rows(spark)
    alone = load_listings(raw, key_kind="dense", only=["listings"])["listings"]
    copied = set(saved.pop("clean"))
    host = set(LISTINGS_STAR.reachable_attributes("host")) - {"host_id"}
    others = {a for n in LISTINGS_STAR.write_order if n != "host" for a in LISTINGS_STAR.wide_attributes(n)}
    assert copied == {c.name for c in LISTINGS_STAR.wide_columns} - host
    assert "host_id" in copied and copied < others
    whole = load_listings(raw, key_kind="dense")["listings"]
    assert len(saved.pop("clean")) == len(LISTINGS_STAR.wide_columns)
    assert sorted(alone.collect()) == sorted(whole.collect())


def test_joining_back_some_columns_joins_only_their_tables(spark):
    tables = load_listings(raw_rows(spark))
    whole = denormalize(LISTINGS_STAR, tables)
    for columns, joins in ((["listing_id", "host_id", "host_name", "host_verifications"], 3), (["name", "host_id"], 0), (["daily_price", "listing_id"], 1)):
        some = denormalize(LISTINGS_STAR, tables, columns=columns)
        assert some.columns == columns
        # Nested dimensions of the host are joined with it.
        assert plan(some).count("HashJoin") + plan(some).count("SortMergeJoin") == joins
        assert sorted(some.collect(), key=str) == sorted(whole.select(*columns).collect(), key=str)
