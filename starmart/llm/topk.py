"""Exact nearest vectors by integer inner product: a ball tree per shard, branch and bound."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import keep

SCALE = 1024
LEAF = 64
# Vectors of a shard. More make fewer shards for the queries to visit; with 64
# components a vector takes 1 kB of a task's memory.
SHARD_ROWS = 8_192
# Queries that one task streams through a shard; a shard is copied for each block of them.
BLOCK_QUERIES = 16_384
# Sums of products below this are exact in a double.
_EXACT = 1 << 52
_LONG = (1 << 63) - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a double; NULL where the vector takes no part."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: F.coalesce(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.when(vector.isNotNull() & ~bad, F.transform(doubles, lambda x: F.floor(x * scale)))


class BallTree:
    """Balls over integer vectors: centre, radius, and the rows of each leaf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.ids, self.vectors = ids, vectors
        self.as_float = vectors.astype(np.float64)
        self.largest = float(np.sqrt((self.as_float**2).sum(1).max(initial=0.0)))
        self.centres, self.radii, self.children, self.rows = [], [], [], []
        waiting = [(np.arange(len(ids)), -1)]
        while waiting:
            rows, parent = waiting.pop()
            at = len(self.radii)
            if parent >= 0:
                self.children[parent].append(at)
            points = self.as_float[rows]
            centre = points.mean(0)
            off = np.sqrt(((points - centre) ** 2).sum(1))
            self.centres.append(centre)
            self.radii.append(float(off.max()))
            self.children.append([])
            self.rows.append(None)
            if len(rows) <= leaf or not off.max():
                self.rows[at] = rows
                continue
            # Split along the line between two far points, at the median.
            one = points[off.argmax()]
            two = points[((points - one) ** 2).sum(1).argmax()]
            order = np.argsort(points @ (two - one), kind="stable")
            half = len(rows) // 2
            waiting += [(rows[order[:half]], at), (rows[order[half:]], at)]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def _scores(self, query: np.ndarray, rows: np.ndarray):
        norm = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        if norm * self.largest < _EXACT:
            return (self.as_float[rows] @ query.astype(np.float64)).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(v, query, strict=True)) for v in self.vectors[rows]]
        return np.array([min(max(x, -_LONG), _LONG) for x in exact], np.int64)

    def search(self, query_id: int, query: np.ndarray, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best, ties to the smaller id; none below ``least``.

        ``least`` is a kth score known from elsewhere. Nodes are visited by their
        bound, query . centre + |query| * radius, best first, and the search ends
        at the first bound below the kth score known so far.
        """
        as_float = query.astype(np.float64)
        norm = float(np.sqrt(as_float @ as_float))
        # Rounding errors of a bound: far less than this part of the largest product.
        slack = 1.0 + 1e-9 * norm * self.largest
        bounds = self.centres @ as_float + norm * self.radii + slack
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        floor = -np.inf if least is None else float(least)
        frontier = [(-bounds[0], 0)]
        while frontier:
            bound, node = heapq.heappop(frontier)
            if -bound < floor:
                break
            if self.rows[node] is None:
                for child in self.children[node]:
                    heapq.heappush(frontier, (-bounds[child], child))
                continue
            rows = self.rows[node]
            rows = rows[self.ids[rows] != query_id]
            ids, scores = np.r_[ids, self.ids[rows]], np.r_[scores, self._scores(query, rows)]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                floor = max(floor, float(scores[-1]))
        if least is not None:
            ids, scores = ids[scores >= least], scores[scores >= least]
        return ids, scores


_FOUND = "query_id long, vec_id long, score long"


def _lists(column) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1])


def _search_shards(k: int, leaf: int):
    """Rows sorted by shard, vectors before queries: build the tree, then stream the queries."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        now, tree, ids, vectors = None, None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            shards, asks, vec_ids, leasts = (batch.column(i).to_pylist() for i in range(4))
            out = ([], [], [])
            for shard, ask, vec_id, least, vector in zip(
                shards, asks, vec_ids, leasts, _lists(batch.column(4)), strict=True
            ):
                if shard != now:
                    now, tree, ids, vectors = shard, None, [], []
                if not ask:
                    # Rows alike in id and vector follow each other and count once.
                    if not ids or ids[-1] != vec_id or not np.array_equal(vectors[-1], vector):
                        ids.append(vec_id)
                        vectors.append(vector)
                    continue
                if tree is None and ids:
                    tree = BallTree(np.array(ids, np.int64), np.array(vectors, np.int64), leaf)
                    ids, vectors = [], []
                if tree is None:
                    continue
                found, scores = tree.search(vec_id, vector, k, least)
                for part, values in zip(out, ([vec_id] * len(found), found, scores), strict=True):
                    part.extend(values)
            if out[0]:
                arrays = [pa.array(x, pa.int64()) for x in out]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query with their rank; tasks keep k a query before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    leaf: int = LEAF,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of each query, all if fewer.

    Every row but the query's own is a candidate; equal scores go to the smaller
    id. Rows with NULL id or vector, or with a component that is NULL or not finite, take
    no part; rows alike in id and vector count once; vectors of other lengths than
    the query's are no candidates. Scores beyond 64 bits are cut to plus or minus
    2^63 - 1 and ranked as such.

    Vectors are dealt to shards of about ``shard_rows`` by a hash of their id, and
    queries to blocks of about ``block_queries``. Each block has a copy of each shard,
    whose tree is built once and the block streams through it: a task holds one shard,
    one batch of queries and k results a query, and grows with neither table. The first
    shard of a length runs alone: its kth scores go with the queries to all other shards,
    where most branches then fall short of them. Queries come to every shard: with
    a share of the rows as queries the work is a product, which the bounds prune.
    """
    rows = keep(
        vectors.select(
            F.col(vec_id).alias("vec_id"),
            quantised(F.col(vector)).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("ask"),
        ).where("vec_id IS NOT NULL AND v IS NOT NULL")
    )
    shards = max(1, -(-rows.count() // shard_rows))
    none = F.lit(None).cast("long")
    place = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    stored = rows.select(F.size("v").alias("d"), place.alias("n"), F.lit(False).alias("ask"), "vec_id", none.alias("least"), "v")
    blocks = max(1, -(-rows.where("ask").count() // block_queries))
    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("b")
    asked = rows.where("ask").select(F.size("v").alias("d"), "vec_id", "v").distinct()
    asked = asked.select("d", block, "vec_id", "v")

    def wave(first: int, last: int, bounded: DataFrame) -> DataFrame:
        sent = bounded.withColumn("n", F.explode(F.sequence(F.lit(first), F.lit(last))))
        sent = sent.select("d", "n", "b", F.lit(True).alias("ask"), "vec_id", "least", "v")
        held = stored.where(F.col("n").between(first, last))
        held = held.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        dealt = held.select(*sent.columns).union(sent).repartition("d", "n", "b")
        dealt = dealt.sortWithinPartitions("d", "n", "b", "ask", "vec_id", "v")
        flat = dealt.select(F.concat_ws(":", "d", "n", "b").alias("shard"), "ask", "vec_id", "least", "v")
        return flat.mapInArrow(_search_shards(k, leaf), _FOUND)

    found = keep(wave(0, 0, asked.withColumn("least", none)))
    if shards > 1:
        least = _best(found, k).where(F.col("rank") == k)
        least = least.select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
        found = found.union(wave(1, shards - 1, asked.join(least, "vec_id", "left")))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
