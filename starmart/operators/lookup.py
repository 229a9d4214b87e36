"""Key lookups: wide or fact rows to dimension rows."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.dims import frequent_tuples
from starmart.operators.keys import has_duplicates, hash_key

# Hot tuples' dimension rows are broadcast up to this number. There are more only where
# tuples do not identify a row; those are left to adaptive execution.
_MOST_HOT_ROWS = 100_000


class FanOutError(ValueError):
    """The lookup columns do not identify a dimension row."""


def common_types(df: DataFrame, dim: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> list[T.DataType]:
    """The type in which each pair of key columns is hashed and compared.

    Spark's own widening: INT and BIGINT meet in BIGINT, decimals in a wider one,
    BIGINT and DOUBLE in DOUBLE. Where the type does not hold all values of a side
    (DOUBLE beyond 2^53, decimals that would need over 38 digits), ``lookup`` leaves those
    that it changes without a match. Raises ``TypeError`` where a pair has no common
    type; a text and a number have none.
    """
    types = []
    for a, b in zip(cols, keys, strict=True):
        pair = [df.schema[a].dataType, dim.schema[b].dataType]
        if pair[0] == pair[1]:
            types.append(pair[0])
            continue
        try:
            if sum(isinstance(t, T.StringType) for t in pair) == 1:
                raise TypeError
            types.append(df.select(a).union(dim.select(b)).schema[0].dataType)
        except (AnalysisException, TypeError):
            names = " and ".join(t.simpleString() for t in pair)
            raise TypeError(f"{a} and {b} cannot be compared: {names}") from None
    return types


# Decimal digits that hold any value of an integral type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# Integral types all of whose values a floating-point type holds.
_EXACT_IN = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}


def _holds(wide: T.DataType, own: T.DataType) -> bool:
    """Whether each value of type ``own`` is one of ``wide``, where ``wide`` is a common type of both sides."""
    if wide == own or not (isinstance(wide, T.NumericType) and isinstance(own, T.NumericType)):
        return True
    if type(wide) in _EXACT_IN:
        return type(own) in _EXACT_IN[type(wide)]
    if not isinstance(wide, T.DecimalType):
        return True
    digits, scale = (own.precision - own.scale, own.scale) if isinstance(own, T.DecimalType) else (_DIGITS.get(type(own), 39), 0)
    return wide.scale >= scale and wide.precision - wide.scale >= digits


def _compared(col: Column, own: T.DataType, wide: T.DataType) -> tuple[Column, Column | None]:
    """``col`` in type ``wide``, and whether it kept its value (None: it always does).

    It did if casting back gives it again. 2^63 - 1 becomes 2^63 as a floating-point
    number and is cut to 2^63 - 1 on the way back, so it is named.
    """
    if _holds(wide, own):
        return col.cast(wide), None
    given = col.try_cast(wide)
    same = F.coalesce(given.try_cast(own) == col, col.isNull())
    if isinstance(own, T.LongType) and isinstance(wide, T.FractionalType):
        same = same & (col.isNull() | (col != F.lit((1 << 63) - 1)))
    return given, same


def _compared_all(df: DataFrame, cols: Sequence[str], types: Sequence[T.DataType]) -> tuple[list[Column], Column | None]:
    pairs = [_compared(F.col(c), df.schema[c].dataType, t) for c, t in zip(cols, types, strict=True)]
    kept = [same for _, same in pairs if same is not None]
    return [value for value, _ in pairs], reduce(and_, kept) if kept else None


def lookup_keys(df: DataFrame, dim: DataFrame, cols: Sequence[str]) -> list[Column]:
    """``cols`` of ``df`` in the types in which ``lookup`` hashes and compares them."""
    return _compared_all(df, cols, common_types(df, dim, cols, cols))[0]


def lookup_hash(df: DataFrame, dim: DataFrame, cols: Sequence[str]) -> Column:
    """The hash by which ``lookup`` finds a tuple; NULL if the other side can hold no equal one."""
    keys, same = _compared_all(df, cols, common_types(df, dim, cols, cols))
    return hash_key(keys) if same is None else F.when(same, hash_key(keys))


def _match(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    pairs = zip(left, right, strict=True)
    terms = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    condition = terms[0]
    for term in terms[1:]:
        condition = condition & term
    return condition


def lookup(
    df: DataFrame,
    dim: DataFrame,
    cols: Sequence[str],
    values: Sequence[str] | str,
    *,
    how: str = "left",
    null_safe: bool = True,
    check_unique: bool = False,
    allow_fan_out: bool = False,
    hot: Sequence[int] = (),
    spread_by: Sequence[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add dimension columns ``values`` to ``df`` by matching ``cols``.

    ``null_safe`` matches NULL with NULL; otherwise a NULL never matches. Both are
    equi-joins. Several columns are compared through their 64-bit hash first, so
    a sort-merge join sorts on one long; the columns themselves stay in the
    condition and decide.

    Key columns of different types are compared, and hashed, in their common type
    (``common_types``); a value that this type cannot hold, on either side, matches nothing.

    ``check_unique`` first makes sure that ``cols`` identify a dimension row, since
    otherwise rows of ``df`` would multiply; ``allow_fan_out`` asks for just that.

    ``hot`` holds hashes of tuples known to be frequent (``frequent_tuples`` of
    ``lookup_keys``).
    Their dimension rows, few and counted, are broadcast; rows with such a tuple find
    theirs there and are dealt by a hash of ``spread_by`` instead of their tuple, so no
    task receives a whole hot group, however large. No row is dropped or copied.

    ``rows`` is the number of rows of ``dim`` (or a bound on it) where the caller has counted
    them. If they are too many to broadcast (``counted_large``) both sides are shuffled, whatever
    Spark makes of the size of the compressed files.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup joins are left or inner, not {how!r}")
    if check_unique and not allow_fan_out and has_duplicates(dim, *cols):
        raise FanOutError(f"several rows share {list(cols)}; name more columns or allow_fan_out")

    values = [values] if isinstance(values, str) else list(values)
    keys = [f"_d{i}" for i in range(len(cols))]
    slim = dim.select(
        *[F.col(c).alias(k) for c, k in zip(cols, keys, strict=True)],
        *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)],
    )
    found = [F.col(f"_v{i}").alias(v) for i, v in enumerate(values)]

    if hot and not spread_by:
        raise ValueError("hot lookups need spread_by: columns that vary within a hot group")
    types = common_types(df, slim, cols, keys)
    given, kept = _compared_all(df, cols, types)
    stored, found_again = _compared_all(slim, keys, types)
    condition = _match(given, stored, null_safe)
    if kept is not None:
        condition = condition & kept
    large = counted_large(slim, rows)
    left, right = df, slim if found_again is None else slim.where(found_again)
    if len(cols) > 1 or hot:
        left = left.withColumn("_lh", hash_key(given))
        right = right.withColumn("_rh", hash_key(stored))
        condition = (F.col("_lh") == F.col("_rh")) & condition
    if hot:
        # As a table: 8 hashes a task would make a long plan of literals.
        hashes = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hot], "_hot_hash long"))
        is_hot = F.col("_rh") == F.col("_hot_hash")
        few = right.join(hashes, is_hot, "left_semi")
        if few.limit(_MOST_HOT_ROWS + 1).count() <= _MOST_HOT_ROWS:
            rest = _shuffled(right.join(hashes, is_hot, "left_anti"), large)
            return _join_hot_apart(left, rest, few, condition, how, hashes, spread_by).select(*df.columns, *found)
        warnings.warn(f"over {_MOST_HOT_ROWS} dimension rows are hot in {list(cols)}: left to adaptive execution", stacklevel=2)
    return left.join(_shuffled(right, large), condition, how).select(*df.columns, *found)


def _shuffled(df: DataFrame, large: bool) -> DataFrame:
    return df.hint("merge") if large else df


def _join_hot_apart(
    left: DataFrame,
    rest: DataFrame,
    few: DataFrame,
    condition: Column,
    how: str,
    hashes: DataFrame,
    spread_by: Sequence[str],
) -> DataFrame:
    """Join with the hot rows ``few`` by broadcast, then with ``rest`` by shuffle.

    Both have the columns ``_rh``, ``_d…`` and ``_v…`` that ``condition`` names. Hot rows
    of ``left`` meet nothing in ``rest``: a random place stands for their hash there.
    """
    marked = left.join(hashes, F.col("_lh") == F.col("_hot_hash"), "left")
    marked = marked.select(*left.columns, F.col("_hot_hash").isNotNull().alias("_hot"))
    place = F.when(F.col("_hot"), F.xxhash64(*spread_by)).otherwise(F.col("_lh"))
    values = [c for c in few.columns if c.startswith("_v")]
    first = marked.join(F.broadcast(few.withColumn("_met", F.lit(True))), condition, "left").select(
        *marked.columns, place.alias("_place"), F.col("_met").alias("_hmet"), *[F.col(v).alias(f"_h{v}") for v in values]
    )
    joined = first.join(rest.withColumn("_met", F.lit(True)), (F.col("_place") == F.col("_rh")) & condition, "left")
    if how == "inner":
        joined = joined.where(F.when(F.col("_hot"), F.col("_hmet")).otherwise(F.col("_met")))
    chosen = {v: F.when(F.col("_hot"), F.col(f"_h{v}")).otherwise(F.col(v)) for v in values}
    return joined.select(*left.columns, *[c.alias(v) for v, c in chosen.items()])


def _broadcast_threshold(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def counted_large(dim: DataFrame, rows: int | None) -> bool:
    """Whether ``rows`` rows of ``dim`` take more than Spark's broadcast threshold in memory.

    Spark's own estimate is the size of the files, scaled by the width of the columns that are
    read. Keys compress to a byte or two each, so it would broadcast tens of millions of them.
    """
    return rows is not None and rows * (8 + dim._jdf.schema().defaultSize()) > _broadcast_threshold(dim)


def may_shuffle(dim: DataFrame, rows: int | None = None) -> bool:
    """Whether a join with ``dim`` may shuffle: unless Spark broadcasts it, by its own
    estimate and threshold, and its ``rows``, if counted, are no more than that. A broadcast
    join knows no skew."""
    size = dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) > _broadcast_threshold(dim) or counted_large(dim, rows)


def lookup_large(
    df: DataFrame,
    dim: DataFrame,
    cols: Sequence[str],
    values: Sequence[str] | str,
    spread_by: Sequence[str],
    hot_share: float | None = None,
    **options,
) -> DataFrame:
    """``lookup`` that finds the hot groups itself, unless Spark broadcasts the dimension.

    ``hot_share`` is the share of the rows from which a tuple is hot; given, they are
    always sought. See ``frequent_tuples`` for what holds otherwise. Spark's estimate says which dimensions
    it would broadcast; these are counted.
    """
    names = [values] if isinstance(values, str) else list(values)
    slim = dim.select(*cols, *names)
    # What Spark shuffles anyway need not be counted.
    rows = None if may_shuffle(slim) else dim.count()
    sought = hot_share is not None or may_shuffle(slim, rows)
    hot = frequent_tuples(df, {"hot": lookup_keys(df, dim, cols)}, hot_share)["hot"] if sought else ()
    return lookup(df, dim, cols, values, hot=hot, spread_by=spread_by, rows=rows, **options)


def fan_out(df: DataFrame, dim: DataFrame, cols: Sequence[str]) -> DataFrame:
    """What joining on ``cols`` would yield, counted without producing the rows.

    ``(*cols, left_rows, dim_rows, joined_rows)``; both sides are reduced to one
    row per tuple before they meet.
    """
    left = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("left_rows"))
    right = dim.groupBy(*cols).agg(F.count(F.lit(1)).alias("dim_rows"))
    joined = lookup(left, right, cols, "dim_rows")
    matches = F.coalesce(F.col("dim_rows"), F.lit(0))
    return joined.select(
        *cols,
        "left_rows",
        matches.alias("dim_rows"),
        (F.col("left_rows") * F.greatest(matches, F.lit(1))).alias("joined_rows"),
    )
