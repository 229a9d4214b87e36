"""Profiles: counts, distinct counts, candidate keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import text_width

# Texts longer than a digest are shuffled as their SHA-256.
_DIGEST_OVER = 64


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)``; on Parquet this reads footers only."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def _as_text(field: T.StructField, value: Column | None = None) -> Column:
    """A text that is the same for two values just if the values are equal.

    Long texts are replaced by a SHA-256 digest behind a marker that keeps them
    apart from short texts, so that long documents are not shuffled whole.
    """
    col, dtype = F.col(field.name) if value is None else value, field.dataType
    if _is_float(dtype):
        return _one_zero(col, dtype).cast("string")
    if isinstance(dtype, T.ArrayType | T.StructType | T.MapType):
        col = F.to_json(_one_zero(col, dtype))
    elif isinstance(dtype, T.BinaryType):
        col = F.hex(col)
    elif isinstance(dtype, T.TimestampType):
        # As local time the two hours of a clock set back would be one.
        return F.unix_micros(col).cast("string")
    elif not isinstance(dtype, T.StringType):
        return col.cast("string")
    digest = F.concat(F.lit("sha256:"), F.sha2(col, 256))
    return F.when(F.length(col) > _DIGEST_OVER, digest).otherwise(col)


def _is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType)


def _one_zero(col: Column, dtype: T.DataType) -> Column:
    """The value with 0.0 for every -0.0 in it: the two are equal."""
    if _is_float(dtype):
        return col + F.lit(0.0).cast(dtype)
    if isinstance(dtype, T.ArrayType) and _has_float(dtype):
        return F.transform(col, lambda x: _one_zero(x, dtype.elementType))
    if isinstance(dtype, T.StructType) and _has_float(dtype):
        fields = F.struct(*[_one_zero(col[f.name], f.dataType).alias(f.name) for f in dtype])
        return F.when(col.isNotNull(), fields)
    return col


def _has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_float(f.dataType) for f in dtype)
    return _is_float(dtype)


def value_text(df: DataFrame, col: str, value: Column | None = None) -> Column:
    """A short text of a column, or of ``value`` of its type, that is equal for two values just if they are."""
    return _as_text(df.schema[col], value)


def value_texts(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Columns ``v0, v1, …``: short texts that are equal just if the values are."""
    return [_as_text(df.schema[c]).alias(f"v{i}") for i, c in enumerate(cols)]


def profile(
    df: DataFrame, cols: Sequence[str] | None = None, error: float | None = None
) -> DataFrame:
    """``(column_name, type, n_rows, n_non_null, n_distinct)`` per column.

    Exact unless ``error`` allows a relative standard deviation of ``n_distinct``;
    then one aggregate of fixed-size sketches does and no value is shuffled.

    Exact, in one scan: each row becomes (column, value) pairs, which collapse within each
    task before they are shuffled by pair; the second aggregate sees one row per
    distinct value and keeps a hot value on no task of its own.
    """
    fields = [f for f in df.schema if cols is None or f.name in cols]
    if error is not None:
        return _column_rows(
            df,
            fields,
            n_non_null=lambda f: F.count(F.col(f.name)),
            n_distinct=lambda f: F.approx_count_distinct(_as_text(f), error),
        )
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("i"), _as_text(f).alias("value"))
            for i, f in enumerate(fields)
        ]
    )
    per_value = (
        df.select(F.inline(pairs)).groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    per_column = per_value.groupBy("i").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_non_null"),
        F.count("value").alias("n_distinct"),
    )
    # From the declared columns, so that an empty table has its rows, too.
    declared = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], "i int, column_name string, type string"
    )
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_rows", "n_non_null", "n_distinct")]
    return F.broadcast(declared).join(per_column, "i", "left").select("column_name", "type", *counts)


def non_null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, type, n_rows, n_non_null)`` per column, no value shuffled."""
    return _column_rows(df, df.schema.fields, n_non_null=lambda f: F.count(F.col(f.name)))


def _column_rows(
    df: DataFrame,
    fields: Sequence[T.StructField],
    **measures: Callable[[T.StructField], Column],
) -> DataFrame:
    """One aggregate row of measures per column, turned into one row per column."""
    aggregates = [
        measure(f).alias(f"{name}_{i}")
        for i, f in enumerate(fields)
        for name, measure in measures.items()
    ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("n").alias("n_rows"),
            *[F.col(f"{name}_{i}").alias(name) for name in measures],
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(F.count(F.lit(1)).alias("n"), *aggregates).select(F.inline(F.array(*rows)))


def candidate_keys(df: DataFrame, *subsets: Sequence[str]) -> DataFrame:
    """``(columns, n_rows, n_distinct, is_key)`` for each subset of columns.

    NULLs count as values. Each subset reads its own columns only and shuffles
    one row per distinct tuple and task.
    """
    parts = []
    for subset in subsets:
        per_tuple = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_tuple.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                F.count(F.lit(1)).alias("n_distinct"),
            ).select(
                F.lit(", ".join(subset)).alias("columns"),
                "n_rows",
                "n_distinct",
                (F.col("n_rows") == F.col("n_distinct")).alias("is_key"),
            )
        )
    return reduce(DataFrame.unionAll, parts)


def max_text_width(df: DataFrame, *cols: str) -> DataFrame:
    """``(column_name, max_width)``: longest text form per column."""
    widths = [F.max(text_width(F.col(c))).alias(f"w{i}") for i, c in enumerate(cols)]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"w{i}").alias("max_width"))
        for i, c in enumerate(cols)
    ]
    return df.agg(*widths).select(F.inline(F.array(*rows)))
