import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators import checks as C
from starmart.operators import profile as P
from starmart.spec import Column, columns, struct_of


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "Ann", 10), (1, "Bob", None), (None, "Cyd", 30), (3, "Dee-Dee", 10)],
        "id int, name string, place int",
    )


def test_primary_key(people):
    assert rows(C.pk_violations(people, "id")) == [(None, 1, "null"), (1, 2, "duplicate")]
    assert rows(C.pk_violations(people, "name")) == []


def test_foreign_key(people, spark):
    places = spark.createDataFrame([(10,), (20,), (None,)], "pid int")
    assert rows(C.fk_orphans(people, "place", places, "pid")) == [(None, 1), (30, 1)]
    assert rows(C.not_in_list(people, "place", places, "pid")) == [(30, 1)]


def test_text_width(people):
    assert rows(C.text_overflow(people, {"name": 3})) == [("name", 3, 7, 1)]
    assert {r.name for r in C.truncate_texts(people, {"name": 3}).collect()} == {"Ann", "Bob", "Cyd", "Dee"}


def test_schema(people):
    want = struct_of(columns("id bigint, name string, age int"))
    assert rows(C.schema_diff(people, want)) == [
        ("age", "int", None, "missing"),
        ("id", "bigint", "int", "type"),
        ("place", None, "int", "unexpected"),
    ]
    with pytest.raises(ValueError, match="age"):
        C.require_schema(people, want)
    assert C.require_schema(people, people.schema) is people


def test_conformance(people):
    declared = (
        Column("id", "int", nullable=False),
        Column("name", "string", max_len=3),
        Column("age", "int"),
    )
    assert rows(C.schema_conformance(people, declared)) == [
        ("age", "int", None, "missing", 4),
        ("id", "int", "int", "ok", 1),
        ("name", "string", "string", "ok", 1),
    ]


def test_row_conservation(people):
    assert C.row_conservation(people, people, "name").first() == (4, 4, 4, True)
    assert C.row_conservation(people, people.union(people), "name").first() == (4, 8, 4, False)
    assert C.row_conservation(people, people, "id").first()[3] is False


def test_columns_equal(people):
    copies = people.select("place", F.col("place").cast("bigint").alias("copy"), "id")
    assert rows(C.columns_equal(copies, ("place", "copy"), ("place", "id"))) == [
        ("place", "copy", True),
        ("place", "id", False),
    ]


def test_profile(spark):
    df = spark.createDataFrame(
        [(0.0, "a" * 100, [1, 2]), (-0.0, "a" * 100, [1, 2]), (None, "a" * 99 + "b", None), (1.5, None, [])],
        "x double, t string, l array<int>",
    )
    assert rows(P.profile(df)) == [
        ("l", "array<int>", 4, 3, 2),
        ("t", "string", 4, 3, 2),
        ("x", "double", 4, 3, 2),
    ]
    assert rows(P.profile(df, ["t"])) == [("t", "string", 4, 3, 2)]
    assert rows(P.non_null_counts(df)) == [
        ("l", "array<int>", 4, 3), ("t", "string", 4, 3), ("x", "double", 4, 3),
    ]


def test_approximate_profile(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 10).alias("digit"))
    got = {r.column_name: r for r in P.profile(df, error=0.02).collect()}
    assert got["digit"].n_distinct == 10 and got["digit"].n_non_null == 20_000
    assert abs(got["id"].n_distinct - 20_000) < 2_000


def test_candidate_keys(people):
    assert rows(P.candidate_keys(people, ["id"], ["id", "name"], ["place"])) == [
        ("id", 4, 3, False),
        ("id, name", 4, 4, True),
        ("place", 4, 3, False),
    ]


def test_counts_and_widths(people):
    assert rows(P.row_counts({"a": people, "b": people.limit(0)})) == [("a", 4), ("b", 0)]
    assert rows(P.max_text_width(people, "name", "place")) == [("name", 7), ("place", 2)]
