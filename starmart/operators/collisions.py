"""Hash keys that collide: a side table of the few tuples that get another key.

Of the tuples that share a hash the first in attribute order keeps it. Each other one is
hashed again with a round number until its key is free. So a key depends on its tuple and
on those it collides with, not on the rest of the table: all other keys stay what they are, in
this load and the next. A fact computes the hash as ever, and only where it is one of the side
table's are tuples compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.keys import hash_key, narrowed
from starmart.sources.store import Store

# The side table is broadcast, so it is only made for this many colliding tuples at most. 64 bits
# have some 3 of them among 10^10 tuples.
MOST_COLLIDING = 100_000
# Rounds of hashing again; each leaves a share of the tuples as small as the table is in the key space.
_MOST_ROUNDS = 64


class TooManyCollisions(ValueError):
    """The hash is too short for the table."""


def colliding_tuples(dim: DataFrame, key: str) -> tuple[int, int]:
    """How many rows of ``dim`` there are, and how many share their key with another."""
    shared = F.when(F.col("count") > 1, F.col("count"))
    found = dim.groupBy(key).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum(shared), F.lit(0)))
    return tuple(found.first())


def side_table(dim: DataFrame, key: str, cols: Sequence[str], scratch: Store, bits: int = 64) -> DataFrame | None:
    """``(_hash, key, *cols)`` of the tuples that must get another key; None if there are none.

    ``dim`` is written and has one row per tuple, keyed by its hash of ``bits``. Raises
    ``TooManyCollisions`` beyond ``MOST_COLLIDING`` tuples or half of all.
    """
    rows, n = colliding_tuples(dim, key)
    if not n:
        return None
    if n > MOST_COLLIDING or 2 * n > rows:
        raise TooManyCollisions(f"{n} of {rows} tuples share their key")
    shared = dim.groupBy(key).count().where("count > 1").select(key)
    order = [F.col(c).asc_nulls_first() for c in cols]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    # Counted above: half of the colliding tuples at most.
    found = dim.join(F.broadcast(shared), key).withColumn("_place", place)
    waiting = scratch.save(f"{key}_colliding", found.where("_place > 1").select(F.col(key).alias("_hash"), *cols))

    settled: list[DataFrame] = []
    for round_ in range(1, _MOST_ROUNDS):
        new = narrowed(hash_key([F.lit(round_), *cols]), bits).alias(key)
        tried = scratch.save(f"{key}_round_{round_}", waiting.select("_hash", new, *cols))
        few = F.broadcast(tried.select(key).distinct())
        taken = reduce(DataFrame.union, [d.select(key).join(few, key, "left_semi") for d in (dim, *settled)])
        first = F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
        met = tried.join(taken.distinct().withColumn("_taken", F.lit(True)), key, "left")
        judged = scratch.save(f"{key}_judged_{round_}", met.withColumn("_free", F.col("_taken").isNull() & first))
        settled.append(judged.where("_free").select("_hash", key, *cols))
        waiting = judged.where("NOT _free").select("_hash", *cols)
        if waiting.isEmpty():
            return reduce(DataFrame.union, settled)
    raise TooManyCollisions(f"no free keys of {bits} bits after {_MOST_ROUNDS} rounds")


def settled_key(df: DataFrame, side: DataFrame, key: str, cols: Sequence[str], hashed: Column, out: str) -> DataFrame:
    """``df`` with column ``out``: ``hashed``, or the key that ``side`` has for the tuple ``cols``.

    The side table is broadcast; it was counted when it was made. NULL matches NULL.
    """
    named = side.select(
        F.col("_hash").alias("_side_hash"), F.col(key).alias("_side_key"), *[F.col(c).alias(f"_side_{i}") for i, c in enumerate(cols)]
    )
    same = hashed == F.col("_side_hash")
    for i, c in enumerate(cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_side_{i}"))
    kept = [c for c in df.columns if c != out]
    return df.join(F.broadcast(named), same, "left").select(F.coalesce("_side_key", hashed).alias(out), *kept)
