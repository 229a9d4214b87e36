"""Surrogate keys.

Three kinds, all BIGINT:

* ``hash``: a function of the attributes alone. The same row has the same key in
  every run, and a fact table can compute its foreign keys without any join.
  Distinct rows may collide, so the keys are checked after they are written;
  ``collisions`` gives those that do other keys.
* ``dense``: 0, 1, 2, ... in attribute order. Exact at any size; a fact table has
  to look the key up.
* ``monotonic``: Spark's partition-based id, unique but dependent on the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.sources.store import Store, workspace

# monotonically_increasing_id() holds the partition number above this many row bits.
_ROW_BITS = 33


def hash_key(cols: Sequence[str | Column]) -> Column:
    """64-bit key of a tuple. ``xxhash64`` skips NULLs, so their places are hashed too.

    Equal values of different types have different hashes: cast them first.
    """
    values = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*values, *[v.isNull() for v in values])


def narrowed(hashed: Column, bits: int) -> Column:
    """The hash for targets whose keys are narrower: from 0 to 2^bits - 1, or as it is at 64 bits."""
    if not 0 < bits <= 64:
        raise ValueError(f"a key has 1 to 64 bits, not {bits}")
    return hashed if bits == 64 else F.shiftrightunsigned(hashed, 64 - bits)


def dense_key(
    distinct: DataFrame, key: str, cols: Sequence[str], store: Store | None = None
) -> DataFrame:
    """Number already distinct rows 0..n-1 in the order of ``cols``, NULLs first.

    A range shuffle plus a sort inside each partition orders the rows globally
    with no single-task step. Written once, with partition number and position,
    each row needs only its partition's offset: a running sum over one count per
    partition, which is small whatever the data size. Two rows never tie, so the
    numbers do not depend on how many partitions there were.
    """
    store = store or workspace(distinct.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in cols]
    placed = store.save(
        f"{key}_placed",
        distinct.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
    )
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    row = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    counts = placed.groupBy(part).agg(F.max(row).alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum(F.col("_last") + 1).over(before), F.lit(0)).alias("_offset"),
    )
    return (
        placed.withColumn("_part", part)
        # One row per partition of the write: bounded by the partition count.
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + row).alias(key), *distinct.columns)
    )


def monotonic_key(distinct: DataFrame, key: str, store: Store | None = None) -> DataFrame:
    """Plan-dependent ids, written at once because a second run may number anew."""
    store = store or workspace(distinct.sparkSession)
    keyed = distinct.select(F.monotonically_increasing_id().alias(key), *distinct.columns)
    return store.save(f"{key}_numbered", keyed)


def has_duplicates(df: DataFrame, *cols: str) -> bool:
    """Whether any tuple of ``cols`` occurs twice; only these columns are read."""
    return not df.groupBy(*cols).count().where("count > 1").isEmpty()
