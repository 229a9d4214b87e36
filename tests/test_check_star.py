"""All checks of a star in one pass against the single checks."""

from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from starmart.operators.checks import check_star, fk_orphans, pk_violations, text_overflow
from starmart.sources.store import workspace
from starmart.spec import Dimension, Reference, Star, columns

STAR = Star(
    dimensions=(
        Dimension("a", "ak", columns("name varchar(3)")),
        Dimension("b", "bk", columns("bk string, w varchar(2), v varchar(1)"), natural_key=True, references=(Reference("ak", "a"),)),
        Dimension("c", "ck", columns("ck decimal(5,1)"), natural_key=True),
    ),
    fact=Dimension(
        "f",
        "id",
        columns("id bigint, note varchar(4)"),
        natural_key=True,
        references=(Reference("ak", "a"), Reference("ck", "c"), Reference("bk", "b")),
    ),
)
LONG = "x" * 100


@pytest.fixture(scope="module")
def tables(spark):
    made = {
        "a": spark.createDataFrame([(1, "one"), (2, "four"), (2, None), (None, "abcd")], "ak long, name string"),
        "b": spark.createDataFrame(
            [("k", 1, "abc", "x"), (LONG, 9, "ab", "xy"), (LONG + "y", None, "é€😀", None), (None, 1, None, "")],
            "bk string, ak int, w string, v string",
        ),
        "c": spark.createDataFrame([(Dec("1.0"),), (Dec("2.5"),)], "ck decimal(5,1)"),
        "f": spark.range(3_000).select(
            F.when(F.col("id") % 100 > 0, F.col("id") % 2_000).alias("id"),
            F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 5).cast("long").alias("ak"),
            # A wider type than the key's, with values that no key can have.
            F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 4 + 0.25).cast("decimal(10,2)").alias("ck"),
            F.when(F.col("id") % 7 > 0, LONG).otherwise("k").alias("bk"),
            F.lpad(F.lit("z"), F.col("id") % 6 + 1, "z").alias("note"),
        ),
    }
    store = workspace(spark)
    return {n: store.save(n, df) for n, df in made.items()}


def single(tables):
    out = {}
    for name in STAR.write_order:
        spec, df = STAR.table(name), tables[name]
        out[name, "primary_key", spec.key] = pk_violations(df, spec.key).count()
        for r in spec.references:
            found = fk_orphans(df, r.column, tables[r.table], STAR.table(r.table).key)
            out[name, "foreign_key", r.column] = found.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        limits = {c.name: c.max_len for c in STAR.table_columns(name) if c.max_len is not None}
        if limits:
            out |= {(name, "text_width", r.column_name): r.n_over for r in text_overflow(df, limits).collect()}
    return out


def together(tables):
    found = [tuple(r) for r in check_star(STAR, tables).collect()]
    assert len(found) == len({r[:3] for r in found})
    return {r[:3]: r[3] for r in found if r[1] != "schema"}


def test_equals_the_single_checks(tables):
    got = together(tables)
    assert got == single(tables)
    assert got["f", "foreign_key", "ck"] == 1_500 and got["b", "foreign_key", "ak"] == 2 and got["a", "primary_key", "ak"] == 2


def test_empty_tables(tables):
    for empty in (list(tables), ["f"], ["a", "c"]):
        some = {n: df.where("false") if n in empty else df for n, df in tables.items()}
        assert together(some) == single(some)


def test_one_scan_of_each_table_and_one_shuffle_of_keys(tables):
    plan = check_star(STAR, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == len(tables)
    physical = check_star(STAR, tables)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning(place") == 2  # by (place, key), then one row per place and task
    assert physical.count("Join") == 1
