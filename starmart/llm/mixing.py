"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import WORD, join_hot, keep, take_rows
from starmart.operators.keys import dense_key

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = 42
# Units rounded by one task at a time, and residuals met in one node of the tree.
GROUP_ROWS, FAN = 2_048, 64
# A group is drawn anew, so often at most, while the unit left fractional holds more than this share of its words.
DRAWS, SMALL = 8, 0.002


def _skey(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``sizes`` (one row per ``source`` with ``source_size``), with ``target``.

    Sources in code point order, NULL last, get the weights in turn and share the
    sum of all sizes by them. A target stops at ``most`` times its source's size;
    what it leaves goes to the others by weight, until none is above. Sources are
    ranked by a range shuffle and summed by aggregates, so any number will do;
    each round stops one more source at least, and few in practice.
    """
    first = F.when(F.col("source").isNull(), 1).otherwise(0)
    ranked = dense_key(sizes.withColumn("no_source", first), "rank", ["no_source", "source"])
    turn = F.pmod("rank", F.lit(len(weights))).cast("int")
    given = F.get(F.array(*map(F.lit, weights)), turn)
    now = keep(ranked.select("source", "source_size", given.alias("weight"), F.lit(None).cast("double").alias("target")))
    limit = F.col("source_size") * most
    while True:
        held = F.col("target").isNotNull()
        total, taken, weight = now.agg(
            F.sum("source_size"), F.sum("target"), F.sum(F.when(~held, F.col("weight")))
        ).first()
        if not weight:
            break
        share = (total - (taken or 0.0)) / weight
        level = F.col("weight") * share
        if now.where(~held & (level > limit)).isEmpty():
            now = now.withColumn("target", F.coalesce("target", level))
            break
        now = keep(now.withColumn("target", F.when(~held & (level > limit), limit).otherwise(F.col("target"))))
    return now.select("source", "source_size", "target")


def pivot(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round fractional ``chances`` (0 to 1) one against the next; at most one stays fractional.

    Two entries trade words until one of them is 0 or 1, in a direction drawn so
    that each keeps its expectation; the words they take together never change.
    Returns the chances and the place of the fractional one, or -1.
    """
    p = chances.astype(float).copy()
    draws = rng.random(len(p))
    at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        w, v = sizes[at], sizes[j]
        up = min((1.0 - p[at]) * w, p[j] * v)
        down = min(p[at] * w, (1.0 - p[j]) * v)
        if draws[j] * (up + down) < down:
            full, empty = up == (1.0 - p[at]) * w, up == p[j] * v
            p[at], p[j] = (1.0 if full else p[at] + up / w), (0.0 if empty else p[j] - up / v)
        else:
            empty, full = down == p[at] * w, down == (1.0 - p[j]) * v
            p[at], p[j] = (0.0 if empty else p[at] - down / w), (1.0 if full else p[j] + down / v)
        at = at if 0.0 < p[at] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return p, at


def _round_groups(level: int, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # Like sizes trade with each other, and what stays fractional at the end is small.
        order = {"words": False, "draw": True, "id": True, "mark": True, "units": True}
        group = group.sort_values(list(order), ascending=list(order.values()), kind="stable").reset_index(drop=True)
        name = f"{seed}:{level}:{group['skey'][0]}:{group['bucket'][0]}"
        rng = np.random.default_rng(zlib.crc32(name.encode()))
        words, chances = group["words"].to_numpy(), group["chance"].to_numpy()
        best = None
        for _ in range(DRAWS):
            tried, at = pivot(words, chances, rng)
            left = words[at] if at >= 0 else 0.0
            if best is None or left < best[0]:
                best = left, tried, at
            if left <= SMALL * words.sum():
                break
        _, group["chance"], at = best
        group["open"] = np.arange(len(group)) == at
        return group

    return run


_UNIT = (
    "skey string, bucket long, id long, mark long, units long, size long, source_size long, target double,"
    " words double, base long, chance double, draw long, open boolean"
)


def copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    seed: int = SEED,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """How often the mix takes each document: a checkpointed row per (id, text hash, source).

    ``skey, id, mark, units, size, source_size, target, copies``: ``units`` rows are alike in
    id, text and source and get ``copies`` together. A source's documents have one rate, target
    / source_size, of 0 to ``most``; the whole part is taken as it is, and the
    fractions are rounded by ``pivot``, weighted with the words, so that the words
    taken differ from the target by one document at most.

    Units are dealt to groups of about ``group_rows`` by a hash of id and text within
    their source, however large it is; each leaves one fractional unit at most, and
    these meet ``FAN`` at a time in a tree until a source has one left, which is
    drawn. Draws depend on the rows, ``seed`` and ``group_rows`` alone: reruns agree.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.xxhash64(text).alias("mark"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    units = keep(rows.groupBy("id", "mark", "source", "size").agg(F.count(F.lit(1)).alias("units")))
    summed = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("units")).alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    summed = keep(summed)
    skey = _skey(F.col("source")).alias("skey")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / group_rows)).alias("buckets")
    targets = source_targets(summed.select("source", "source_size"), weights, most)
    known = targets.select(skey, "source_size", "target").join(summed.select(skey, buckets), "skey")
    known = keep(known)
    most_buckets = known.agg(F.max("buckets")).first()[0] or 1

    rate = F.col("target") / F.col("source_size") * F.col("units")
    wanted = F.when(F.col("size") > 0, rate).otherwise(F.lit(0.0))
    mixed = F.xxhash64(F.lit(seed), "id", "mark")
    ready = (
        join_hot(units.withColumn("skey", skey).drop("source"), known, "skey")
        .withColumn("wanted", wanted)
        .withColumn("base", F.floor("wanted"))
        .withColumn("chance", F.col("wanted") - F.col("base"))
        .withColumn("words", F.col("size").cast("double"))
        .withColumn("draw", mixed)
        .withColumn("bucket", F.pmod(mixed, F.col("buckets")))
    )
    columns = [c.split()[0] for c in _UNIT.split(", ")]
    now = ready.withColumn("open", F.lit(False)).select(*columns)
    done, level = [], 0
    while True:
        tried = keep(now.groupBy("skey", "bucket").applyInPandas(_round_groups(level, seed), _UNIT))
        done.append(tried.where("NOT open"))
        now = tried.where("open").withColumn("bucket", F.floor(F.col("bucket") / FAN))
        if most_buckets <= 1:
            break
        most_buckets, level = -(-most_buckets // FAN), level + 1
    # One fractional unit a source at most: drawn with its chance.
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "skey"), F.lit(1 << 30)) / (1 << 30)
    done.append(now.withColumn("chance", F.when(part < F.col("chance"), 1.0).otherwise(0.0)))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    taken = (F.col("base") + F.round("chance")).cast("long")
    return every.select("skey", "id", "mark", "units", "size", "source_size", "target", taken.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row; see ``copies``.

    NULL text has size 0; a document without words takes none. Rows alike in id,
    text and source share their copies as evenly as they can.
    """
    found = copies(docs, **options)
    each = found.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "units")))
    whole = F.floor(F.col("copies") / F.col("units"))
    extra = F.when(F.col("k") <= F.col("copies") % F.col("units"), 1).otherwise(0)
    taken = ((whole + extra) * F.col("size")).cast("long")
    return each.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def _row_hash(docs: DataFrame) -> Column:
    """Hash of all columns; a NULL counts with its place."""
    cols = [F.to_json(F.struct(docs[c])) if "map<" in t else docs[c] for c, t in docs.dtypes]
    return F.xxhash64(*cols, *[docs[c].isNull() for c in docs.columns])


def mixed_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; documents without words go.

    Rows alike in id, text and source share their copies as evenly as they can,
    in the order of a hash of all columns; only rows alike in all are interchangeable.
    """
    found = copies(docs, doc_id=doc_id, text=text, source=source, **options)
    kinds = docs.select(
        docs[doc_id].cast("long").alias("id"),
        F.xxhash64(docs[text]).alias("mark"),
        _skey(docs[source]).alias("skey"),
        _row_hash(docs).alias("row"),
    )
    kinds = kinds.groupBy("id", "mark", "skey", "row").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("id", "mark", "skey").orderBy("row")
    before = F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    kinds = kinds.withColumn("before", F.coalesce(before, F.lit(0))).alias("k")
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("id", "mark", "skey")]
    extra = F.col("copies") % F.col("units") - F.col("before")
    share = F.floor(F.col("copies") / F.col("units")) * F.col("rows") + F.greatest(F.lit(0), F.least("rows", extra))
    shared = kinds.join(found.alias("f"), same).select("k.id", F.col("row").alias("mark"), "rows", share.alias("copies"))
    picks = shared.groupBy("id", "mark").agg(F.sum("rows").alias("rows"), F.sum("copies").alias("copies"))
    return take_rows(docs, keep(picks), doc_id, _row_hash(docs))
