import pytest

from starmart.plans.listings import LISTINGS_STAR, RAW_COLUMNS
from starmart.plans.orders import ORDERS_STAR
from starmart.sources.catalog import jdbc_options, star_ddl
from starmart.spec import Dimension, Reference, Star, columns


def test_columns():
    a, b, c = columns("a bigint, b varchar(20), c decimal(18,15)")
    assert (a.type, b.type, b.max_len, c.type) == ("bigint", "string", 20, "decimal(18,15)")
    assert columns("x numeric")[0].spark_type.simpleString() == "decimal(10,0)"


def test_listing_tables():
    assert len(RAW_COLUMNS) == 75
    assert len(LISTINGS_STAR.by_name) == 10
    assert len(LISTINGS_STAR.table_columns("listings")) == 13
    assert [c.name for c in LISTINGS_STAR.table_columns("host")][:3] == [
        "host_id", "host_listings_diags_id", "host_quals_id",
    ]


def test_write_order():
    for star in (LISTINGS_STAR, ORDERS_STAR):
        order = star.write_order
        for name in order:
            for ref in star.table(name).references:
                assert order.index(ref.table) < order.index(name)
        assert order[-1] == star.fact.name


def test_bad_stars():
    leaf = Dimension("a", "a_id", columns("x int"))
    snow = Dimension("b", "b_id", columns("y int"), references=(Reference("a_id", "a"),))
    fact = Dimension("f", "f_id", columns("f_id bigint"), natural_key=True)
    with pytest.raises(ValueError, match="natural key"):
        Star((leaf, snow), fact)
    loop = Dimension("l", "l", columns("l int"), True, (Reference("l", "l"),))
    with pytest.raises(ValueError, match="cycle"):
        Star((loop,), fact).write_order  # noqa: B018


def test_ddl():
    statements = star_ddl(LISTINGS_STAR, "db", widths=True)
    assert len(statements) == 10
    host = next(s for s in statements if "db.host (" in s)
    assert "host_url VARCHAR(50)" in host
    assert "'primary_key' = 'host_id'" in host
    assert "'foreign_key.host_quals_id' = 'host_quals_diags'" in host
    assert "avail_info_id BIGINT" in statements[-1]


def test_jdbc_options():
    plain = jdbc_options("jdbc:mysql://h/db", "listings")
    assert "numPartitions" not in plain
    split = jdbc_options("jdbc:mysql://h/db", "listings", "id", 0, 1_000_000, 64)
    assert (split["partitionColumn"], split["upperBound"], split["numPartitions"]) == (
        "id", "1000000", "64",
    )
    with pytest.raises(ValueError):
        jdbc_options("jdbc:mysql://h/db", "listings", "id", 0)
