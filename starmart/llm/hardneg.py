"""Hard negatives: candidate blocks along a Hilbert curve, chosen by zone maps.

Vectors are sorted along a Hilbert curve through their space and written as Parquet, a row
per block of neighbours on the curve with its zone map: least and greatest value
of every dimension, the labels it has and its least id. Interval arithmetic over a zone map
bounds all inner products of an anchor with the block from above and below. A
block is read for an anchor only if it may hold one of the best rows of the anchor's label,
or then a row inside one of its score windows that is better than what the window has. What
it has comes from the anchor's home block, its neighbours on the curve, which is read first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import keep
from starmart.llm.topk import quantised
from starmart.sources.store import workspace

SCALE = 256
# Rows of a block; a block of 64 dimensions takes 512 kB.
BLOCK_ROWS = 1_024
# Bits of a dimension in a row's place on the curve.
CURVE_BITS = 4
# Anchors and zone maps that meet in one task to be compared, and anchors that read a block together.
SLICE_ANCHORS = 2_048
PAGE_ZONES = 2_048
# Sums of products below this are exact in a double.
_EXACT = 1 << 52
_LONG = (1 << 63) - 1


def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of rows of ``points``, whole numbers below 2^bits,
    as texts of bytes that sort like the places.

    Skilling's transform: coordinates are turned into the transpose of the place, bit by bit from
    the highest, all rows at once; the bits of the transpose, dealt out by dimension, are the place.
    """
    x = points.astype(np.int64).copy()
    n, dims = x.shape
    if not n or not dims:
        return [b""] * n
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for d in range(dims):
            turned = (x[:, d] & high) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    gray = np.zeros(n, np.int64)
    for bit in range(bits - 1, 0, -1):
        gray ^= np.where(x[:, -1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= gray[:, None]
    levels = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return [row.tobytes() for row in np.packbits(levels.reshape(n, -1).astype(np.uint8), axis=1)]


def _arrays(column) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1])


def _with_curve(low: int, high: int, bits: int):
    """Adds each row's place; components from ``low`` to ``high`` are cut into 2^bits cells."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _arrays(batch.column("v"))
            places: list[bytes] = [b""] * len(vectors)
            for size in {len(v) for v in vectors}:
                rows = [i for i, v in enumerate(vectors) if len(v) == size]
                points = np.array([vectors[i] for i in rows], np.float64).reshape(len(rows), size)
                cells = np.floor((points - low) / (float(high) - low + 1) * (1 << bits))
                for i, key in zip(rows, hilbert_keys(np.clip(cells, 0, (1 << bits) - 1), bits), strict=True):
                    places[i] = key
            yield batch.append_column("place", pa.array(places, pa.binary()))

    return run


_BLOCKS = (
    "block long, size int, ids array<long>, labels array<string>, asks array<boolean>, vectors binary,"
    " low array<long>, high array<long>, kinds array<string>, least_id long"
)


def _cut(rows_of_block: int):
    """Rows in order to a row per block: its rows and its zone map."""

    def packed(part: int, number: int, rows: list) -> dict:
        ids, labels, asks, vectors = zip(*rows, strict=True)
        matrix = np.array(vectors, np.int64).reshape(len(ids), -1)
        return {
            "block": (part << 32) | number,
            "size": matrix.shape[1],
            "ids": ids,
            "labels": labels,
            "asks": asks,
            "vectors": matrix.tobytes(),
            "low": matrix.min(0).tolist(),
            "high": matrix.max(0).tolist(),
            "kinds": sorted(set(labels)),
            "least_id": min(ids),
        }

    schema = pa.schema(
        [
            ("block", pa.int64()), ("size", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())),
            ("asks", pa.list_(pa.bool_())), ("vectors", pa.binary()), ("low", pa.list_(pa.int64())),
            ("high", pa.list_(pa.int64())), ("kinds", pa.list_(pa.string())), ("least_id", pa.int64()),
        ]
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        rows, part, number = [], 0, 0
        for batch in batches:
            parts, ids, labels, asks = (batch.column(i).to_pylist() for i in range(4))
            for here, vec_id, label, ask, vector in zip(parts, ids, labels, asks, _arrays(batch.column(4)), strict=True):
                if rows and (len(rows) >= rows_of_block or len(rows[0][3]) != len(vector)):
                    yield pa.RecordBatch.from_pylist([packed(part, number, rows)], schema)
                    rows, number = [], number + 1
                part = here
                rows.append((vec_id, label, ask, vector))
        if rows:
            yield pa.RecordBatch.from_pylist([packed(part, number, rows)], schema)

    return run


_ANCHORS = "home long, anchor long, anchor_id long, label string, size int, v binary"
_ASKED = f"{_ANCHORS}, tops array<long>, floors array<long>, floor_ids array<long>"


def _anchors(batches) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that ask, numbered by their place, with the block they are at home in."""
    for batch in batches:
        out = {n: [] for n in ("home", "anchor", "anchor_id", "label", "size", "v")}
        for row in batch.to_pylist():
            vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(row["ids"]), -1)
            for i in np.flatnonzero(row["asks"]):
                out["home"].append(row["block"])
                out["anchor"].append((row["block"] << 11) + int(i))
                out["anchor_id"].append(row["ids"][i])
                out["label"].append(row["labels"][i])
                out["size"].append(row["size"])
                out["v"].append(vectors[i].tobytes())
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out.values(), types, strict=True)], names=list(out))


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every anchor with any vector between ``low`` and
    ``high``: each component takes the end of the interval that its sign calls for."""
    up, down = np.maximum(anchors, 0.0), np.minimum(anchors, 0.0)
    most = np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = np.where(most < _EXACT, 0.0, 1.0 + 1e-9 * most)
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def scores(vectors: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all pairs; beyond 64 bits cut to plus or minus 2^63 - 1."""
    a, b = vectors.astype(np.float64), anchors.astype(np.float64)
    if (np.abs(a).sum(1).max(initial=0.0)) * np.abs(b).max(initial=0.0) < _EXACT:
        return (a @ b.T).astype(np.int64)
    exact = vectors.astype(object) @ anchors.astype(object).T
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


def _unpack(table: pa.Table, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("v").to_pylist()), np.int64).reshape(table.num_rows, size)


def _choose(schema: pa.Schema):
    """Zone maps of a page against a slice of anchors: the blocks that each anchor must read."""

    def run(anchors: pa.Table, zones: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        if anchors.num_rows and zones.num_rows:
            size = anchors.column("size")[0].as_py()
            asked = _unpack(anchors, size).astype(np.float64)
            low, high = (np.array(zones.column(c).to_pylist(), np.float64).reshape(zones.num_rows, size) for c in ("low", "high"))
            least, most = bounds(asked, low, high)
            kinds = [set(k) for k in zones.column("kinds").to_pylist()]
            least_ids = zones.column("least_id").to_numpy()
            labels, blocks = anchors.column("label").to_pylist(), zones.column("block").to_numpy()
            homes = anchors.column("home").to_numpy()
            limits = [anchors.column(c).to_pylist() for c in ("tops", "floors", "floor_ids")]
            # By label: which zones have a row of it, and which a row of another.
            has = {x: np.array([x in k for k in kinds]) for x in set(labels)}
            other = {x: np.array([len(k) > 1 or x not in k for k in kinds]) for x in set(labels)}
            chosen, at = [], []
            for i, (label, tops, floors, ids) in enumerate(zip(labels, *limits, strict=True)):
                reach = np.zeros(len(blocks), bool)
                for top, floor, floor_id in zip(tops or [None], floors, ids, strict=True):
                    hit = (most[i] > floor) | ((most[i] == floor) & (least_ids <= floor_id))
                    reach |= hit if top is None else hit & (least[i] <= top)
                reach &= (has[label] if tops is None else other[label]) & (blocks != homes[i])
                found = np.flatnonzero(reach)
                chosen.append(np.full(len(found), i))
                at.append(blocks[found])
            rows = anchors.take(pa.array(np.concatenate(chosen))).select(schema.names[1:])
            out.append(rows.add_column(0, "block", pa.array(np.concatenate(at), pa.int64())).cast(schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


_FOUND = "anchor long, top long, vec_id long, score long"


def _read(k: int):
    """A block against the anchors that read it: at most ``k`` rows for each anchor and window."""

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if block.num_rows and asked.num_rows:
            (row,) = block.to_pylist()
            ids, labels = np.array(row["ids"], np.int64), np.array(row["labels"], object)
            vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["size"])
            anchors = _unpack(asked, row["size"])
            products = scores(vectors, anchors)
            # Rows by id: a stable sort by score then has ties by id.
            by_id = np.argsort(ids, kind="stable")
            columns = [asked.column(c).to_pylist() for c in ("anchor", "anchor_id", "label", "tops", "floors", "floor_ids")]
            for i, (anchor, anchor_id, label, tops, floors, floor_ids) in enumerate(zip(*columns, strict=True)):
                same = labels[by_id] == label
                rows = by_id[same if tops is None else ~same]
                if tops is None:
                    own = ids[rows] == anchor_id
                    if own.any():
                        own[own] = (vectors[rows[own]] == anchors[i]).all(1)
                        rows = rows[~own]
                rows = rows[np.argsort(-products[rows, i], kind="stable")]
                falling = -products[rows, i]
                for top, floor, floor_id in zip(tops or [None], floors, floor_ids, strict=True):
                    start = 0 if top is None else int(np.searchsorted(falling, -top))
                    best = rows[start : start + k]
                    value = products[best, i]
                    best = best[(value > floor) | ((value == floor) & (ids[best] <= floor_id))]
                    n = len(best)
                    for part, found in zip(out, ([anchor] * n, [top] * n, ids[best], products[best, i]), strict=True):
                        part.extend(found)
        return pa.table([pa.array(x, pa.int64()) for x in out], ["anchor", "top", "vec_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and window; tasks keep k of each before the shuffle."""
    order = Window.partitionBy("anchor", "top").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class _Blocks:
    """The written blocks, and how anchors meet their zone maps and rows."""

    def __init__(self, table: DataFrame, anchors: DataFrame):
        self.table = table
        self.pages = max(1, -(-table.count() // PAGE_ZONES))
        self.slices = max(1, -(-anchors.count() // SLICE_ANCHORS))

    def _slice(self) -> Column:
        return F.pmod(F.xxhash64("anchor"), F.lit(self.slices)).cast("int").alias("slice")

    def choose(self, asked: DataFrame) -> DataFrame:
        """``(block, …)``: ``asked`` once for every block but home that may hold what it asks for."""
        page = F.pmod(F.xxhash64("block"), F.lit(self.pages)).cast("int").alias("page")
        zones = self.table.select("block", "size", "low", "high", "kinds", "least_id", page)
        zones = zones.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1))))
        spread = asked.select("*", self._slice(), F.explode(F.sequence(F.lit(0), F.lit(self.pages - 1))).alias("page"))
        schema = f"block long, {_ASKED}"
        tile = ("size", "page", "slice")
        return spread.groupBy(*tile).cogroup(zones.groupBy(*tile)).applyInArrow(_choose(_schema()), schema)

    def read(self, asked: DataFrame, k: int) -> DataFrame:
        """Rows that ``asked`` finds in the blocks it names; no other block is read."""
        sliced = asked.withColumn("slice", self._slice())
        wanted = sliced.select(F.col("block").alias("_b"), F.col("slice").alias("_s")).distinct()
        held = self.table.join(wanted, F.col("block") == F.col("_b"))
        held = held.select("block", F.col("_s").alias("slice"), "size", "ids", "labels", "vectors")
        met = held.groupBy("block", "slice").cogroup(sliced.groupBy("block", "slice"))
        return met.applyInArrow(_read(k), _FOUND)

    def search(self, asked: DataFrame, k: int) -> DataFrame:
        """Home blocks first; what they hold bounds what other blocks must offer."""
        at_home = keep(_best(self.read(asked.withColumn("block", F.col("home")), k), k))
        last = at_home.where(F.col("rank") == k).select("anchor", "top", F.struct("score", "vec_id").alias("last"))
        last = last.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("top", F.lit(0)), "last"))).alias("last"))
        # Windows of an anchor have different tops; where there is none its entry stands at 0.
        tops = F.coalesce("tops", F.array(F.lit(0).cast("long")))
        found = F.transform(tops, lambda t: F.try_element_at("last", t))
        floors = F.zip_with("floors", found, lambda a, b: F.greatest(a, F.coalesce(b["score"], a)))
        floor_ids = F.zip_with("floor_ids", found, lambda a, b: F.coalesce(b["vec_id"], a))
        bounded = asked.join(last, "anchor", "left").select(
            *[c for c in asked.columns if c not in ("floors", "floor_ids")], floors.alias("floors"), floor_ids.alias("floor_ids")
        )
        chosen = keep(self.choose(bounded))
        return _best(at_home.drop("rank").unionByName(self.read(chosen, k)), k)


def _schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema(
        [("block", pa.int64()), ("home", pa.int64()), ("anchor", pa.int64()), ("anchor_id", pa.int64()), ("label", pa.string()),
         ("size", pa.int32()), ("v", pa.binary()), ("tops", longs), ("floors", longs), ("floor_ids", longs)]
    )


def write_blocks(vectors: DataFrame, is_anchor: Column, label: Column, vec_id: str, vector: str, scale: int) -> DataFrame:
    """The vectors that take part, sorted along the curve and written in blocks (``_BLOCKS``).

    Rows are dealt by ranges of (vector's length, place, id): many vectors in one place are
    spread by their ids.
    """
    store = workspace(vectors.sparkSession)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("ask"),
        quantised(F.col(vector), scale).alias("v"),
    )
    # Rows alike in all count once.
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").distinct()
    rows = store.save("rows", rows)
    low, high = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    placed = rows.mapInArrow(_with_curve(low or 0, high or 0, CURVE_BITS), "vec_id long, label string, ask boolean, v array<long>, place binary")
    order = [F.size("v"), "place", "vec_id", "label"]
    # Written first: the ranges are found in a pass of its own.
    placed = store.save("placed", placed).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = placed.select(F.spark_partition_id().alias("part"), "vec_id", "label", "ask", "v").mapInArrow(_cut(BLOCK_ROWS), _BLOCKS)
    return store.save("blocks", cut)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of two vectors of floor(``scale`` * component). For each
    anchor its ``positives`` best other rows of its label are found, and for each of these the
    ``negatives`` best rows of other labels that score from ``least_percent`` of the positive's
    score to all of it; ties go to the smaller id. A negative positive score has no such rows.

    Rows with NULL id, label or vector, or a component that is NULL or not finite, take no
    part; vectors of another length than the anchor's are no candidates. Rows alike in id, label and
    vector count once; rows alike in id only are different rows. Scores beyond 64 bits are
    cut and ranked as such.

    Work: every anchor meets every zone map, in pages and slices of fixed size; rows are
    read only for the pairs that the bounds leave, each block once for a slice of
    anchors. A task holds a block and a slice, or a page and a slice.
    """
    blocks = write_blocks(vectors, is_anchor, label, vec_id, vector, scale)
    anchors = keep(blocks.mapInArrow(_anchors, _ANCHORS))
    index = _Blocks(blocks, anchors)
    longs = "array<long>"
    none = F.lit(None).cast(longs)
    first = anchors.select("*", none.alias("tops"), F.array(F.lit(-_LONG - 1)).alias("floors"), F.array(F.lit(_LONG)).alias("floor_ids"))
    near = keep(index.search(first, positives))

    # A window for each score that a positive has: from its share, rounded up, to all of it.
    top = F.col("score").cast("decimal(38,0)")
    floor = F.ceil(top * least_percent / 100).cast("long")
    window = near.where("score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_set(F.struct(F.col("score").alias("top"), floor.alias("floor")))).alias("w"))
    asked = anchors.join(window, "anchor").select(
        *anchors.columns,
        F.col("w.top").alias("tops"),
        F.col("w.floor").alias("floors"),
        F.transform("w", lambda _: F.lit(_LONG)).alias("floor_ids"),
    )
    far = index.search(asked, negatives)
    pairs = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = far.select("anchor", F.col("top").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = pairs.join(found, ["anchor", "positive_score"]).join(anchors.select("anchor", "anchor_id"), "anchor")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
