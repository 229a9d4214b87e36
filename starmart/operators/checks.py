"""Schema and integrity checks. Each returns what it found as a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.lookup import common_types
from starmart.operators.profile import value_text
from starmart.spec import Column, Star, struct_of

ISSUES = "column_name string, expected string, actual string, issue string"


def schema_issues(actual: T.StructType, expected: T.StructType) -> list[tuple]:
    """``(column, expected type, actual type, issue)`` for each difference."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    found = [(n, t, None, "missing") for n, t in want.items() if n not in have]
    found += [(n, t, have[n], "type") for n, t in want.items() if n in have and have[n] != t]
    found += [(n, None, t, "unexpected") for n, t in have.items() if n not in want]
    return found


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame(schema_issues(df.schema, expected), ISSUES)


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` if it has the expected columns and types, else raise."""
    found = schema_issues(df.schema, expected)
    if found:
        raise ValueError("schema differs: " + "; ".join(map(str, found)))
    return df


def schema_conformance(df: DataFrame, declared: Iterable[Column]) -> DataFrame:
    """Declared columns against the data: types compared, values counted.

    ``n_bad`` counts the rows that break the declaration: values that do not fit
    the declared type, NULLs in a required column, texts beyond the declared
    width. A missing column breaks it in every row. One aggregate over one scan.
    """
    declared = list(declared)
    have = {f.name: f.dataType for f in df.schema}
    counts, rows = [F.count(F.lit(1)).alias("n")], []
    for i, c in enumerate(declared):
        if c.name in have:
            col = F.col(c.name)
            bad = col.isNotNull() & col.try_cast(c.spark_type).isNull()
            if not c.nullable:
                bad = bad | col.isNull()
            if c.max_len is not None:
                bad = bad | F.coalesce(F.length(col.cast("string")) > c.max_len, F.lit(False))
            counts.append(F.count(F.when(bad, 1)).alias(f"b{i}"))
        actual = have[c.name].simpleString() if c.name in have else None
        expected = c.spark_type.simpleString()
        rows.append(
            F.struct(
                F.lit(c.name).alias("column_name"),
                F.lit(expected).alias("expected"),
                F.lit(actual).cast("string").alias("actual"),
                F.lit("missing" if actual is None else "ok" if actual == expected else "type").alias(
                    "issue"
                ),
                (F.col("n") if actual is None else F.col(f"b{i}")).alias("n_bad"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def pk_violations(df: DataFrame, *key: str) -> DataFrame:
    """``(*key, n_rows, issue)`` for keys that repeat or hold a NULL."""
    is_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(is_null | (F.col("n_rows") > 1))
        .withColumn("issue", F.when(is_null, F.lit("null")).otherwise(F.lit("duplicate")))
    )


def fk_orphans(df: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """``(fk, n_rows)`` for foreign keys without a parent row, NULLs included.

    Referencing rows are counted per key first, so the join moves one row per
    key and a hot key weighs no more than any other.
    """
    used = df.groupBy(F.col(fk)).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = parent.select(F.col(key).alias("_parent"))
    return used.join(keys, F.col(fk) == F.col("_parent"), "left_anti")


def text_overflow(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per column ``(column_name, max_len, longest, n_over)``: one aggregate, one scan."""
    counts, rows = [], []
    for i, (name, limit) in enumerate(limits.items()):
        width = F.length(F.col(name))
        counts += [
            F.max(width).alias(f"m{i}"),
            F.count(F.when(width > limit, 1)).alias(f"o{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(limit).alias("max_len"),
                F.col(f"m{i}").alias("longest"),
                F.col(f"o{i}").alias("n_over"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def truncate_texts(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Cut texts to the declared width; only on request, since it loses data."""
    return df.withColumns({n: F.substring(F.col(n), 1, w) for n, w in limits.items()})


def not_in_list(df: DataFrame, col: str, allowed: DataFrame, allowed_col: str) -> DataFrame:
    """``(col, n_rows)`` for non-null values that the list does not have."""
    return fk_orphans(df.where(F.col(col).isNotNull()), col, allowed, allowed_col)


def row_conservation(source: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """One row: rows in, rows out, distinct keys out, and whether they agree."""
    none = F.lit(0).cast("bigint")
    rows = source.agg(F.count(F.lit(1)).alias("source_rows")).select(
        "source_rows", none.alias("fact_rows"), none.alias("fact_keys")
    )
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    facts = per_key.agg(F.sum("n").alias("n"), F.count(key).alias("fact_keys")).select(
        none.alias("source_rows"), F.coalesce("n", none).alias("fact_rows"), "fact_keys"
    )
    names = ("source_rows", "fact_rows", "fact_keys")
    both = rows.union(facts).agg(*[F.sum(n).alias(n) for n in names])
    same = (F.col("source_rows") == F.col("fact_rows")) & (
        F.col("fact_rows") == F.col("fact_keys")
    )
    return both.withColumn("conserved", same)


def columns_equal(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Per pair: do the two columns agree in every row (NULL equals NULL)?"""
    counts = [
        F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias(f"e{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    rows = [
        F.struct(
            F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"e{i}").alias("equal")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def check_star(star: Star, tables: Mapping[str, DataFrame]) -> DataFrame:
    """All declared checks: ``(table_name, check, column_name, violations)``.

    Checks: ``schema`` (columns and types), ``primary_key`` (keys that repeat or
    are NULL), ``foreign_key`` (rows without a parent) and ``text_width``.

    Each table is scanned once. A row yields a record per key it has or refers to,
    marked with the table the key is of and the role it plays, and one for each text that is too
    wide. Records collapse in the tasks, so a hot key is one record a task; one shuffle
    brings all roles of a key together, and every check is a sum over these groups.
    """
    spark = next(iter(tables.values())).sparkSession
    number = {name: i for i, name in enumerate(star.write_order)}
    # References to one table are its roles 1, 2, …; role 0 is the key itself.
    roles: dict[str, int] = dict.fromkeys(number, 0)
    found, kinds, records = [], [], []
    for name in star.write_order:
        spec, df = star.table(name), tables[name]
        declared = star.table_columns(name)
        found.append((name, "schema", None, len(schema_issues(df.schema, struct_of(declared)))))
        entries = [_record(number[name], 0, value_text(df, spec.key))]
        kinds.append((name, "primary_key", spec.key, number[name], 0))
        for ref in spec.references:
            roles[ref.table] += 1
            used = _in_type_of(df, ref.column, tables[ref.table], star.table(ref.table).key)
            entries.append(_record(number[ref.table], roles[ref.table], used))
            kinds.append((name, "foreign_key", ref.column, number[ref.table], roles[ref.table]))
        for i, c in enumerate(c for c in declared if c.max_len is not None):
            # Places of their own, below those of the tables' keys.
            place = -1 - (number[name] * 1_000 + i)
            entries.append(F.when(F.length(F.col(c.name)) > c.max_len, _record(place, 0, F.lit(None).cast("string"))))
            kinds.append((name, "text_width", c.name, place, 0))
        records.append(df.select(F.inline(F.array_compact(F.array(*entries)))))

    most = max(roles.values(), default=0)
    counted = [F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(most + 1)]
    groups = reduce(DataFrame.union, records).groupBy("place", "key").agg(*counted)
    absent = F.col("key").isNull()
    repeated = F.when(F.col("place") < 0, F.col("n0")).otherwise(
        F.when((F.col("n0") > 1) | (absent & (F.col("n0") > 0)), 1).otherwise(0)
    )
    orphans = [F.sum(F.when((F.col("n0") == 0) | absent, F.col(f"n{r}")).otherwise(0)) for r in range(1, most + 1)]
    sums = groups.groupBy("place").agg(F.array(F.sum(repeated), *orphans).alias("sums"))
    declared = spark.createDataFrame(
        kinds, "table_name string, check string, column_name string, place int, role int"
    )
    checked = F.broadcast(declared).join(sums, "place", "left").select(
        "table_name", "check", "column_name", F.coalesce(F.get("sums", F.col("role")), F.lit(0)).alias("violations")
    )
    return _metadata(spark, found).unionByName(checked)


def _in_type_of(df: DataFrame, fk: str, parent: DataFrame, key: str) -> SparkColumn:
    """The text of a foreign key as a key of ``parent``; NULL for a value that no such key can have."""
    type_ = parent.schema[key].dataType
    if df.schema[fk].dataType == type_:
        return value_text(df, fk)
    (common,) = common_types(df, parent, [fk], [key])
    same = F.col(fk).try_cast(type_)
    return F.when(same.cast(common) == F.col(fk).cast(common), value_text(parent, key, same))


def _record(place: int, role: int, key: SparkColumn) -> SparkColumn:
    return F.struct(F.lit(place).alias("place"), F.lit(role).alias("role"), key.alias("key"))


def _metadata(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows, "table_name string, check string, column_name string, violations bigint"
    )
