"""Several versions of one natural key: the latest one, or all with the time they were valid.

A dimension that is split off rows of several scrapes has a row per version. The fact
keeps its rows, but joining back would multiply them; here each key gets one version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_versions(df: DataFrame, key: str, attributes: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``(key, *attributes)``: of each key the version of the row that is greatest in ``by``.

    NULLs in ``by`` are least. Rows alike in all of ``by`` are decided by the attributes
    themselves, the greatest in their order, so the result depends on no order of rows. All
    attributes come from one row. A NULL key is a key like any other. One aggregation, combined in the tasks: a key
    with a third of all rows is one row a task.
    """
    others = [a for a in attributes if a != key]
    version = F.struct(*[F.col(a) for a in others]) if others else F.struct(F.lit(0))
    order = F.struct(*[F.col(b).alias(f"by{i}") for i, b in enumerate(by)], version.alias("version"))
    # One struct decides and carries: the version is its last field.
    found = df.groupBy(key).agg(F.max(order).alias("_latest"))
    return found.select(key, *[F.col(f"_latest.version.{a}").alias(a) for a in others])


def version_ranges(df: DataFrame, key: str, attributes: Sequence[str], at: str, by: Sequence[str] = ()) -> DataFrame:
    """``(key, *attributes, valid_from, valid_to)``: every version of every key, by time ``at``.

    At each time a key has one version, that of the row greatest in ``by`` as in
    ``latest_versions``; times without a change are merged into one range. ``valid_to`` is the
    next version's start, which the range does not include, and NULL for the last one.
    A version that comes back has two ranges. Rows without a time take no part.

    Rows collapse to one per key and time before the window, which runs over the times of a key.
    """
    others = [a for a in attributes if a != key]
    each = df.where(F.col(at).isNotNull()).withColumn("_at", F.col(at))
    version = F.struct(*[F.col(a) for a in others])
    order = F.struct(*[F.col(b).alias(f"by{i}") for i, b in enumerate(by)], version.alias("version"))
    one = each.groupBy(key, "_at").agg(F.max(order).alias("_latest")).select(key, "_at", F.col("_latest.version").alias("_version"))
    along = Window.partitionBy(key).orderBy("_at")
    changed = F.row_number().over(along).eqNullSafe(1) | ~F.lag("_version").over(along).eqNullSafe(F.col("_version"))
    starts = one.withColumn("_new", changed).where("_new")
    return starts.select(
        key,
        *[F.col(f"_version.{a}").alias(a) for a in others],
        F.col("_at").alias("valid_from"),
        F.lead("_at").over(along).alias("valid_to"),
    )
