"""Dimension extraction."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.collisions import TooManyCollisions, settled_key, side_table
from starmart.operators.keys import dense_key, hash_key, monotonic_key, narrowed
from starmart.sources.store import Store, workspace

# Sketches are first merged within this many groups of tasks.
_SKETCH_GROUPS = 128
# Groups of fewer rows burden no task, however many tasks there are; they are not hot of themselves.
_LEAST_ROWS = 1_000
# A sketch holds four tuples for each that may be found, a million at most.
_LEAST_SHARE = 4e-6

KEY_KINDS = ("hash", "dense", "monotonic")


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Deduplicate on ``cols``, NULLs equal.

    Rows collapse inside each map task before the shuffle, so a tuple held by a
    third of the table costs the shuffle one row per task.
    """
    return df.select(*cols).distinct()


def extract_dim(
    df: DataFrame,
    cols: Sequence[str],
    key: str,
    kind: str = "dense",
    store: Store | None = None,
    bits: int = 64,
) -> DataFrame:
    """``(key, *cols)`` with one row per distinct tuple of ``cols``; hash keys have ``bits``."""
    distinct = distinct_rows(df, cols)
    if kind == "hash":
        return distinct.select(narrowed(hash_key(cols), bits).alias(key), *cols)
    if kind == "dense":
        return dense_key(distinct, key, cols, store)
    if kind == "monotonic":
        return monotonic_key(distinct, key, store)
    raise ValueError(f"unknown key kind {kind!r}, expected one of {KEY_KINDS}")


def save_dim(df: DataFrame, name: str, cols: Sequence[str], key: str, kind: str, store: Store) -> tuple[DataFrame, str]:
    """Write a dimension; return it with the key kind it ended up with (see ``save_settled_dim``)."""
    return save_settled_dim(df, name, cols, key, kind, store)[:2]


def save_settled_dim(
    df: DataFrame,
    name: str,
    cols: Sequence[str],
    key: str,
    kind: str,
    store: Store,
    scratch: Store | None = None,
    bits: int = 64,
) -> tuple[DataFrame, str, DataFrame | None]:
    """Write a dimension; return it with the key kind it ended up with and its side table.

    Hash keys are tested for collisions on the written table. Tuples that collide get
    other keys, which are written as table ``<name>_collisions`` (``side_table``); all other
    keys stay. Only a hash that is far too short for its table (more collisions than
    a side table may have) has the dimension numbered densely instead. ``scratch`` takes
    intermediate tables, which nothing reads once this returns.
    """
    scratch = scratch or workspace(df.sparkSession)
    saved = store.save(name, extract_dim(df, cols, key, kind, scratch, bits))
    if kind != "hash":
        return saved, kind, None
    try:
        side = side_table(saved, key, cols, scratch, bits)
    except TooManyCollisions:
        renumbered = dense_key(distinct_rows(saved, cols), key, cols, scratch)
        return store.save(name, renumbered, replace=True), "dense", None
    if side is None:
        return saved, kind, None
    side = store.save(f"{name}_collisions", side)
    given = scratch.save(f"{name}_settled", settled_key(saved, side, key, cols, F.col(key), key))
    return store.save(name, given, replace=True), kind, side


def frequent_tuples(
    df: DataFrame, tuples: Mapping[str, Sequence[str | Column]], share: float | None = None
) -> dict[str, list[int]]:
    """Hashes (``hash_key``) of the tuples that hold ``share`` or more of all rows (see ``frequent_shares``)."""
    return {name: list(found) for name, found in frequent_shares(df, tuples, share).items()}


def frequent_shares(
    df: DataFrame, tuples: Mapping[str, Sequence[str | Column]], share: float | None = None
) -> dict[str, dict[int, float]]:
    """Hashes (``hash_key``, of columns or expressions) of the tuples that hold ``share`` or more
    of all rows, each with its share.

    Without ``share`` a tuple counts that has more rows than an eighth of what a task gets on
    average, one of 8 times the shuffle partitions, and a thousand rows. As the partitions grow with the data, so
    do the tuples sought, and no task's load depends on the data's size.

    Takes several sets of columns and finds all of them in one scan: a frequent-items
    sketch of fixed size per set and task, merged in two steps so that no single
    task merges the sketches of all others. At most ``1 / share`` hashes per set
    come back, whatever the data size. A sketch may err in its counts, which is
    harmless: the hashes only say how a lookup distributes its rows, not what it
    finds.
    """
    if not tuples:
        return {}
    floor = 2
    if share is None:
        share = 1 / (8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        floor = _LEAST_ROWS
    share = max(share, _LEAST_SHARE)
    most = math.ceil(1 / share)
    size = F.lit(4 * most)
    group = F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("_group")
    sketches = [
        F.call_function("approx_top_k_accumulate", hash_key(cols), size).alias(name)
        for name, cols in tuples.items()
    ]
    merged = [F.call_function("approx_top_k_combine", F.col(n), size).alias(n) for n in tuples]
    top = [F.call_function("approx_top_k_estimate", F.col(n), F.lit(most)).alias(n) for n in tuples]
    found = (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("_rows"), *sketches)
        .groupBy(F.lit(0).alias("_all"))
        .agg(F.sum("_rows").alias("_rows"), *merged)
        .select("_rows", *top)
        .first()
    )
    if found is None:
        return {name: {} for name in tuples}
    least = max(floor, found["_rows"] * share)
    return {name: {t["item"]: t["count"] / found["_rows"] for t in found[name] if t["count"] >= least} for name in tuples}
