"""Typing: casts driven by a schema, reject counts, type-checked null fills."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.spec import Column

_INTEGRAL = {
    T.ByteType(): 8,
    T.ShortType(): 16,
    T.IntegerType(): 32,
    T.LongType(): 64,
}


# What Spark's casts strip at both ends: blanks and control characters of ASCII.
_STRIPPED = r"[\x00-\x20\x7F]*"
_WITH_POINT = rf"^{_STRIPPED}[+-]?(\d+\.\d*|\.\d+){_STRIPPED}\z"
_NO_WHOLE_PART = rf"^{_STRIPPED}[+-]?\."


def _may_be_number(col: SparkColumn) -> SparkColumn:
    """The first character is none with which no number begins, as in 'N/A' or '$5'.

    A failing cast raises and discards an exception per value, which costs far
    more than this look at one character. The text is not copied: what
    Spark's cast strips passes, and the cast strips it.
    """
    first = F.ascii(col)
    return ~(first.between(ord("!"), ord("*")) | first.between(ord(":"), ord("~")))


def number_text(col: SparkColumn, type_: str | T.DataType) -> SparkColumn:
    """Text to a decimal or floating number; NULL if it is none or does not fit."""
    return F.when(_may_be_number(col), col.try_cast(type_))


def integer_text(col: SparkColumn, type_: str | T.DataType) -> SparkColumn:
    """Text to an integer; decimals are cut off, as in '4.0' from a float column, or '.5'."""
    whole = F.substring_index(col, ".", 1).try_cast(type_)
    return (
        F.when(~_may_be_number(col), F.lit(None))
        .when(F.instr(col, ".") == 0, col.try_cast(type_))
        .when(col.rlike(_WITH_POINT), F.when(col.rlike(_NO_WHOLE_PART), F.lit(0).cast(type_)).otherwise(whole))
    )


def cast_column(name: str, source: T.DataType, target: T.DataType) -> SparkColumn:
    """NULL for values that do not fit, with ANSI mode on or off."""
    col = F.col(name)
    if source == target:
        return col
    if isinstance(source, T.StringType):
        if target in _INTEGRAL:
            return integer_text(col, target)
        if isinstance(target, T.DecimalType):
            return number_text(col, target)
    return col.try_cast(target)


def cast_schema(df: DataFrame, schema: Iterable[Column], keep_others: bool = True) -> DataFrame:
    """Cast the columns named in ``schema`` in one projection.

    Columns outside ``schema`` pass through unless ``keep_others`` is false, in
    which case the result has exactly the schema's columns in its order.
    """
    targets = {c.name: c for c in schema}
    sources = {f.name: f.dataType for f in df.schema}
    missing = targets.keys() - sources.keys()
    if missing:
        raise ValueError(f"columns to cast are absent: {sorted(missing)}")
    names = df.columns if keep_others else list(targets)
    return df.select(
        *[
            cast_column(n, sources[n], targets[n].spark_type).alias(n) if n in targets else F.col(n)
            for n in names
        ]
    )


def cast_rejects(df: DataFrame, schema: Iterable[Column]) -> DataFrame:
    """Per column: how many non-null values would be lost by ``cast_schema``.

    One aggregate over one scan, then turned from a wide row into
    ``(column, type, n_values, n_rejects)``.
    """
    schema = list(schema)
    sources = {f.name: f.dataType for f in df.schema}
    counts = []
    for i, c in enumerate(schema):
        lost = F.col(c.name).isNotNull() & cast_column(c.name, sources[c.name], c.spark_type).isNull()
        counts += [
            F.count(F.col(c.name)).alias(f"n{i}"),
            F.count(F.when(lost, 1)).alias(f"r{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c.name).alias("column_name"),
            F.lit(c.type).alias("type"),
            F.col(f"n{i}").alias("n_values"),
            F.col(f"r{i}").alias("n_rejects"),
        )
        for i, c in enumerate(schema)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _fits(value: object, type_: T.DataType) -> bool:
    if isinstance(type_, T.StringType):
        return isinstance(value, str)
    if isinstance(type_, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(type_, T.DateType):
        if isinstance(value, str):
            try:
                datetime.date.fromisoformat(value)
            except ValueError:
                return False
            return True
        return isinstance(value, datetime.date)
    if isinstance(value, bool) or not isinstance(value, int | float | Decimal):
        return False
    if type_ in _INTEGRAL:
        bound = 2 ** (_INTEGRAL[type_] - 1)
        return value == int(value) and -bound <= value < bound
    if isinstance(type_, T.DecimalType):
        try:
            exact = Decimal(str(value)).quantize(
                Decimal(1).scaleb(-type_.scale), rounding=ROUND_HALF_UP
            )
        except InvalidOperation:
            return False
        return len(exact.as_tuple().digits) <= type_.precision and exact == Decimal(str(value))
    return isinstance(type_, T.FractionalType)


def fill_nulls(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Replace NULL per column, refusing fill values the column cannot hold.

    A fill such as ``"00-00-00"`` for a DATE would silently do nothing (or fail
    at run time under ANSI); here it raises while the plan is being built.
    """
    types = {f.name: f.dataType for f in df.schema}
    absent = fills.keys() - types.keys()
    if absent:
        raise ValueError(f"columns to fill are absent: {sorted(absent)}")
    bad = {n: v for n, v in fills.items() if not _fits(v, types[n])}
    if bad:
        detail = ", ".join(f"{n} {types[n].simpleString()} <- {v!r}" for n, v in bad.items())
        raise ValueError(f"fill values do not fit their columns: {detail}")
    return df.select(
        *[
            F.coalesce(F.col(n), F.lit(fills[n]).cast(types[n])).alias(n) if n in fills else F.col(n)
            for n in df.columns
        ]
    )
