"""Search for the smallest sets of columns that identify a row.

Level by level through the lattice of column sets: sets of one column, of two, and so on. A
set is a candidate if all its subsets one smaller are known not to be keys; so no superset of a
key is ever looked at. Two rows that agree on a set of columns show that neither it nor
any subset is a key: such agree sets, taken from a bounded sample, refute most
candidates without reading the table. What is left is checked exactly, each candidate once, and
a failed check yields two more rows whose agree set refutes others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.profile import value_texts
from starmart.sources.store import workspace

# Rows of the sample: their pairs are compared on the driver, 8 MB a column and block.
SAMPLE_ROWS = 2_000
_BLOCK = 500


class AgreeSets:
    """Sets of columns on which two rows were seen to agree, as bits; only the largest are kept."""

    def __init__(self) -> None:
        self.largest: list[int] = []

    def add(self, found: Iterable[int]) -> None:
        for new in sorted(set(found), key=int.bit_count, reverse=True):
            if not any(new & old == new for old in self.largest):
                self.largest = [old for old in self.largest if old & new != old] + [new]

    def refute(self, columns: int) -> bool:
        return any(columns & seen == columns for seen in self.largest)


def _agreements(rows: Sequence[Sequence[str | None]]) -> Iterator[int]:
    """The agree set of every pair of rows; NULL agrees with NULL."""
    if len(rows) < 2:
        return
    numbers: dict = {}
    codes = np.array([[numbers.setdefault(v, len(numbers)) for v in column] for column in zip(*rows, strict=True)])
    wide = len(codes) > 62
    for start in range(0, len(rows), _BLOCK):
        block = codes[:, start : start + _BLOCK]
        if wide:
            for i in range(block.shape[1]):
                same = codes[:, start + i + 1 :] == block[:, i, None]
                for pair in np.unique(same, axis=1).T:
                    yield sum(1 << int(c) for c in np.flatnonzero(pair))
            continue
        seen = np.zeros((block.shape[1], len(rows)), np.int64)
        for i, column in enumerate(codes):
            seen |= (block[i][:, None] == column[None, :]).astype(np.int64) << i
        later = np.arange(len(rows))[None, :] > np.arange(start, start + block.shape[1])[:, None]
        yield from map(int, np.unique(seen[later]))


def _witness(df: DataFrame, names: Sequence[str], subset: Sequence[str]) -> list | None:
    """None if ``subset`` is a key, else two rows that agree on it.

    The check groups by the subset alone, combined in tasks; the rows are fetched
    by a filter on the tuple that repeats (none, if it holds nested values).
    """
    repeated = df.groupBy(*subset).count().where("count > 1").limit(1).first()
    if repeated is None:
        return None
    if any(isinstance(df.schema[c].dataType, T.ArrayType | T.StructType) for c in subset):
        return []
    match = reduce(and_, [F.col(c).eqNullSafe(F.lit(repeated[c]).cast(df.schema[c].dataType)) for c in subset])
    texts = value_texts(df, names)
    return [[r[f"v{i}"] for i in range(len(names))] for r in df.where(match).select(*texts).limit(2).collect()]


def minimal_keys(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    width: int = 3,
    sample_rows: int = SAMPLE_ROWS,
    parallel_checks: int = 4,
    staged: bool = False,
) -> list[tuple[str, ...]]:
    """All keys of ``df`` among ``cols`` with at most ``width`` columns of which no column can be left out.

    NULLs count as values, so NULL repeated is no key. In an empty table, or one of a single
    row, each column is a key. Columns that cannot be grouped (maps) are left out. Keys come by width, then in the order of ``cols``.

    ``df`` is written once unless ``staged`` says that it reads from files. The driver holds
    ``sample_rows`` rows, long texts as digests, and two rows per failed check. A level's
    checks run ``parallel_checks`` at a time, each over its own columns.
    """
    if not staged:
        df = workspace(df.sparkSession).save("rows", df)
    maps = {f.name for f in df.schema if f.dataType.typeName() in ("map", "variant")}
    names = [c for c in (cols or df.columns) if c not in maps]
    bit = {c: 1 << i for i, c in enumerate(names)}

    def bits(subset: Iterable[str]) -> int:
        return sum(bit[c] for c in subset)

    seen = AgreeSets()
    texts = value_texts(df, names)
    # The least hashes: a sample that does not depend on how the rows lie in files.
    sample = df.select(*texts).orderBy(F.xxhash64(*[f"v{i}" for i in range(len(names))])).limit(sample_rows)
    seen.add(_agreements([tuple(r) for r in sample.collect()]))

    keys: list[tuple[str, ...]] = []
    no_keys: set[tuple[str, ...]] = {()}
    with ThreadPoolExecutor(max_workers=parallel_checks) as pool:
        for size in range(1, min(width, len(names)) + 1):
            level = [s for s in combinations(names, size) if all(c in no_keys for c in combinations(s, size - 1))]
            refuted = {s for s in level if seen.refute(bits(s))}
            waiting = [s for s in level if s not in refuted]
            while waiting:
                now, waiting = waiting[:parallel_checks], waiting[parallel_checks:]
                for subset, rows in zip(now, pool.map(lambda s: _witness(df, names, s), now), strict=True):
                    if rows is None:
                        keys.append(subset)
                    else:
                        refuted.add(subset)
                        seen.add([bits(subset), *_agreements(rows)])
                refuted |= {s for s in waiting if seen.refute(bits(s))}
                waiting = [s for s in waiting if s not in refuted]
            no_keys = refuted
    return keys


def key_table(spark, found: Iterable[tuple[str, tuple[str, ...]]]) -> DataFrame:
    """``(table_name, columns, width)`` of keys found."""
    rows = [(table, ", ".join(key), len(key)) for table, key in found]
    return spark.createDataFrame(rows, "table_name string, columns string, width int")
