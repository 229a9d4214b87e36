"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has 64 bits. Two fingerprints that differ in at most 3 bits are
linked. Cut into a ring of 4 segments of 16 bits, such a pair has a segment from
which on the differences of the first l segments are at most l * 3 / 4, rounded
down, for every l: 0, 1, 2, 3. (If every start broke its budget somewhere, the
broken chains laid end to end around the ring would add up to more than 3.)

So a pair is sought only where a segment agrees and the next one differs in one
bit at most; then one of the halves of the next one agrees as well. Each
fingerprint is therefore filed under 8 keys of 24 bits: 4 starts, 2 halves. Pairs
within a file pass the chain of budgets 1 and 2 before the full count of bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import join_hot, keep, take_rows
from starmart.llm.components import components

BITS, SEGMENT, MOST = 64, 16, 3
SHINGLE = 3
SEED = 42

# A file with more fingerprints than this is cut further.
MAX_FILE = 65_536

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 20


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded block at a time."""
    at = 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            gap = _SPACE.search(data, end)
            end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of all word shingles, repeats included; 0 for a text without words."""
    ones, total, last = np.zeros(BITS, np.int64), 0, []
    hashed = xxhash.xxh64_intdigest
    for block in _words((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)):
        words = last + block
        if len(words) >= width:
            runs = zip(*(words[i:] for i in range(width)), strict=False)
            count = len(words) - width + 1
            hashes = np.fromiter((hashed(b" ".join(r), SEED) for r in runs), np.uint64, count)
            for part in np.array_split(hashes, -(-count // 16_384)):
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
            total += count
            last = words[len(words) - width + 1 :]
        else:
            last = words
    if not total and last:
        hashes = np.array([hashed(b" ".join(last), SEED)], np.uint64)
        ones, total = np.unpackbits(hashes.view(np.uint8)).astype(np.int64), 1
    set_ = np.packbits(2 * ones > total) if total else np.zeros(8, np.uint8)
    return int(set_.view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``fp``: the fingerprint as a signed BIGINT."""
    rest = [c for c in docs.columns if c != text]

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = np.array([fingerprint(t.as_py()) for t in batch.column(at)], np.uint64)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], [*rest, "fp"])

    schema = docs.select(*rest).schema.add("fp", "long")
    return docs.select(*rest, text).mapInArrow(run, schema)


def _turned(value, start: int):
    """Rotate so that segment ``start`` comes first."""
    by = SEGMENT * start
    return (value << np.uint64(by)) | (value >> np.uint64(BITS - by)) if by else value


def _linked(a, b):
    """Which pairs of turned fingerprints keep all budgets of the chain."""
    x = a ^ b
    ok = np.bitwise_count(x >> np.uint64(BITS - SEGMENT)) == 0
    for segments in (2, 3, 4):
        at = np.flatnonzero(ok)
        if not at.size:
            break
        spent = np.bitwise_count(x[at] >> np.uint64(BITS - SEGMENT * segments))
        ok[at] = spent <= segments * MOST * SEGMENT // BITS
    return ok


def _forest(fps: np.ndarray, start: int) -> tuple[list, list]:
    """Edges that connect what is linked within one file, one per fingerprint at most.

    A fingerprint is compared only with those not reached yet, so a file of close
    copies costs little more than reading it.
    """
    turned = _turned(fps, start)
    left, todo, waiting = np.arange(len(fps)), [], [[], []]
    while left.size:
        todo, left = [left[0]], left[1:]
        while todo and left.size:
            at = todo.pop()
            near = _linked(turned[at], turned[left])
            if near.any():
                reached = left[near]
                waiting[0].append(np.full(reached.size, fps[at]))
                waiting[1].append(fps[reached])
                todo.extend(reached)
                left = left[~near]
    return waiting[0], waiting[1]


def _link_files(batches) -> Iterator[pa.RecordBatch]:
    """Rows (file, start, fp) sorted by file: a forest of links for each file."""

    def links(files, starts, fps):
        cuts = np.flatnonzero(np.diff(files)) + 1
        begins, ends = np.r_[0, cuts], np.r_[cuts, len(files)]
        sizes = ends - begins
        a, b = [], []
        for start in range(BITS // SEGMENT):
            two = begins[(sizes == 2) & (starts[begins] == start)]
            if two.size:
                near = _linked(_turned(fps[two], start), _turned(fps[two + 1], start))
                a.append(fps[two[near]])
                b.append(fps[two[near] + 1])
        for k in np.flatnonzero(sizes > 2):
            more = _forest(fps[begins[k] : ends[k]], int(starts[begins[k]]))
            a += more[0]
            b += more[1]
        if a:
            found = [np.concatenate(x).view(np.int64) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b"])

    kept: list[tuple] = []
    for batch in batches:
        files, starts, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(files):
            continue
        kept.append((files, starts, fps.view(np.uint64)))
        if files[0] == files[-1] and kept[0][0][0] == files[0]:
            continue
        files, starts, fps = (np.concatenate(x) for x in zip(*kept, strict=True))
        last = np.searchsorted(files, files[-1])
        yield from links(files[:last], starts[:last], fps[:last])
        kept = [(files[last:], starts[last:], fps[last:])]
    if kept:
        yield from links(*(np.concatenate(x) for x in zip(*kept, strict=True)))


def _bits(value, low: int, n: int):
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _file(nodes: DataFrame, max_file: int) -> DataFrame:
    """(file, start, fp): each fingerprint under all its keys.

    ``rest`` holds the bits a key leaves open. A file of more than ``max_file``
    fingerprints is cut: its open bits form 4 blocks, of which one must agree in
    a pair with 3 differences at most, so each fingerprint is filed anew under
    each block. After two cuts 22 bits at most are open: 4 million fingerprints,
    32 MB, are the most a file can hold at any data size.
    """
    fp = F.col("fp")
    filed = []
    for start in range(BITS // SEGMENT):
        by = SEGMENT * start
        turned = F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by)) if by else fp
        first, upper, lower, open_ = (_bits(turned, *x) for x in ((48, 16), (40, 8), (32, 8), (0, 32)))
        for half, (same, other) in enumerate(((upper, lower), (lower, upper))):
            filed.append(
                F.struct(
                    (F.lit(2 * start + half).cast("long") * (1 << 24) + first * 256 + same).alias("file"),
                    F.lit(start).cast("int").alias("start"),
                    (other * (1 << 32) + open_).alias("rest"),
                )
            )
    rows = nodes.select(fp, F.explode(F.array(*filed)).alias("f")).select("f.*", "fp")
    base = 0
    for width, blocks, widest in ((40, (10, 10, 10, 10), 10), (30, (8, 8, 7, 7), 8)):
        large = keep(rows.groupBy("file").count().where(F.col("count") > max_file).select("file"))
        if large.isEmpty():
            break
        # Files of one cut are numbered apart from those of another.
        before, base = base, 1 << (50 if width == 40 else 60)
        cut, low = [], width
        for k, n in enumerate(blocks):
            low -= n
            number = ((F.col("file") - before) * 4 + k) * (1 << widest) + _bits(F.col("rest"), low, n)
            rest = F.shiftrightunsigned("rest", low + n) * (1 << low) + _bits(F.col("rest"), 0, low)
            cut.append(F.struct((number + base).alias("file"), "start", rest.alias("rest")))
        parts = rows.join(large, "file", "left_semi").select("fp", F.explode(F.array(*cut)).alias("f"))
        whole = rows.join(large, "file", "left_anti").select("file", "start", "rest", "fp")
        rows = whole.union(parts.select("f.file", "f.start", "f.rest", "fp"))
    return rows.select("file", "start", "fp")


def links(nodes: DataFrame, max_file: int = MAX_FILE) -> DataFrame:
    """Edges ``(a, b)`` that connect all linked fingerprints among distinct ``fp``.

    Not all pairs: within each file a spanning forest of its links, so the edges
    grow with the fingerprints (8 per fingerprint at most while no file is cut)
    and not with the square of a group of copies. No link between different
    components is lost.
    """
    filed = _file(nodes, max_file).repartition("file").sortWithinPartitions("file", "fp")
    return filed.mapInArrow(_link_files, "a long, b long")


def classes(rows: DataFrame, max_file: int = MAX_FILE) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint of ``rows``; ``rows`` is checkpointed.

    Equal fingerprints are one node, so exact copies cost nothing further.
    """
    nodes = rows.select("fp").distinct()
    linked = components(links(nodes, max_file)).withColumnRenamed("node", "fp")
    joined = nodes.join(linked, "fp", "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_file: int = MAX_FILE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Two texts are linked when their fingerprints differ in 3 bits or fewer;
    ``component_id`` is the smallest id that links reach. NULL text counts as
    empty, and texts without words have fingerprint zero, linked like any other.
    A NULL id is never a component's smallest: it gets the smallest other id, or
    NULL where there is none. Repeated rows come back as often as they came.
    Other columns of ``docs`` are not looked at.
    """
    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = keep(fingerprints(plain))
    rooted = classes(rows, max_file)
    ids = rows.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = keep(ids.join(rooted, "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = keep(join_hot(rooted.select("fp", "root"), named, "root").select("fp", "component_id"))
    return join_hot(rows, member, "fp").select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_file: int = MAX_FILE) -> DataFrame:
    """The rows of ``docs`` with one row of each component left: that of the smallest id.

    NULL ids come last; among rows of one id the smallest text hash stays, and of
    rows alike in both just one. Columns stay as they are.
    """
    plain = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    rows = keep(fingerprints(plain))
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "mark")
    per_fp = rows.groupBy("fp").agg(F.min(first).alias("first"))
    rooted = per_fp.join(classes(rows, max_file), "fp")
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.mark")
    counted = rows.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    same = (F.col("c.mark") == F.col("n.mark")) & F.col("c.id").eqNullSafe(F.col("n.id"))
    picks = chosen.alias("c").join(counted.alias("n"), same).select("c.id", "c.mark", "n.rows", F.lit(1).alias("copies"))
    return take_rows(docs, keep(picks), doc_id, F.xxhash64(text))
