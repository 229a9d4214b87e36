"""All key lookups of a fact in one join.

One lookup after another shuffles the rows once for each dimension that is not
broadcast. Here each row becomes a triple (row, reference, tuple hash) for each reference, all
triples meet all dimensions' (reference, tuple hash, key) in one join, and one
regrouping by row puts the keys side by side. The rows go through two shuffles,
whatever the number of dimensions; their attributes ride on the first triple.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.lookup import counted_large

# Rows of one tuple go to as many parts as eighths of a task's mean load they make up.
_PARTS_PER_TASK = 8


def _with_parts(df: DataFrame, hot: Mapping[str, Mapping[int, float]], names: Sequence[str]) -> DataFrame:
    """``df`` with the number of parts of each (``_ref``, ``_hash``): 1 unless it is hot."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = [
        (i, h, math.ceil(share * tasks * _PARTS_PER_TASK))
        for i, name in enumerate(names)
        for h, share in hot.get(name, {}).items()
    ]
    if not rows:
        return df.withColumn("_parts", F.lit(1))
    # As many as the sketch finds: 8 for each task and reference at most.
    table = F.broadcast(df.sparkSession.createDataFrame(rows, "_hot_ref int, _hot_hash long, _n int"))
    same = (F.col("_ref") == F.col("_hot_ref")) & (F.col("_hash") == F.col("_hot_hash"))
    return df.join(table, same, "left").select(*df.columns, F.greatest(F.coalesce("_n", F.lit(1)), F.lit(1)).alias("_parts"))


def lookup_all(
    df: DataFrame,
    lookups: Mapping[str, tuple[Column, DataFrame]],
    kept: Sequence[str],
    hot: Mapping[str, Mapping[int, float]] | None = None,
    counted: int | None = None,
) -> DataFrame:
    """``kept`` columns of ``df`` with a key column for each of ``lookups``.

    A lookup is the hash of a row's tuple and a dimension ``(hash, key)``, each hash once:
    then no row is multiplied. A hash that is not found, or NULL, gives NULL. Rows need no key of
    their own and may repeat; ``df`` should read from files, so that they are numbered
    alike if a task is repeated.

    ``hot`` has the shares of frequent tuples (``frequent_shares``) by lookup: such a group is dealt
    to several parts by row number, and its dimension row is copied to each, in all no
    more than 8 copies a task and lookup. Results do not depend on it. ``counted`` is the number of rows of all
    dimensions, if known: too many of them are not broadcast (``counted_large``).
    """
    if not lookups:
        return df.select(*kept)
    names = list(lookups)
    payload = F.struct(*kept) if kept else F.struct(F.lit(0).alias("_none"))
    none = F.lit(None).cast(df.select(payload).schema[0].dataType)
    triples = F.array(
        *[
            F.struct(F.lit(i).alias("_ref"), lookups[n][0].alias("_hash"), (none if i else payload).alias("_row_values"))
            for i, n in enumerate(names)
        ]
    )
    rows = df.select(F.monotonically_increasing_id().alias("_row"), triples.alias("_all")).select("_row", F.inline("_all"))
    hot = hot or {}
    part = F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int").alias("_part")
    rows = _with_parts(rows, hot, names).select("_row", "_ref", "_hash", "_row_values", part)

    # Positions, not names: dimensions may call their columns anything.
    dims = [lookups[n][1].toDF("_hash", "_key").select(F.lit(i).alias("_ref"), "_hash", "_key") for i, n in enumerate(names)]
    found = _with_parts(reduce(DataFrame.union, dims), hot, names)
    found = found.select("_ref", "_hash", "_key", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))

    if counted_large(found, counted):
        found = found.hint("merge")
    joined = rows.join(found, ["_ref", "_hash", "_part"], "left")
    keys = [F.max(F.when(F.col("_ref") == i, F.col("_key"))).alias(f"_k{i}") for i in range(len(names))]
    # Dealt by row before the aggregation: partial sums of single triples would save nothing.
    by_row = joined.repartition("_row").groupBy("_row").agg(F.first("_row_values", ignorenulls=True).alias("_row_values"), *keys)
    return by_row.select(*[F.col(f"_row_values.{c}").alias(c) for c in kept], *[F.col(f"_k{i}").alias(n) for i, n in enumerate(names)])
