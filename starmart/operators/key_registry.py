"""Dense keys that survive the next load: an append-only map from tuple to key.

Each load brings its distinct tuples. Those that the registry has keep their keys; the
rest are numbered in attribute order from where the last load ended, and appended. The map
is bucketed and sorted by the hash of the tuple: the anti-join of a new load reads it in
place and shuffles the load's tuples only, so a load costs what it brings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.dims import distinct_rows
from starmart.operators.keys import dense_key, hash_key
from starmart.sources.store import Store, workspace

_HASH = "_tuple"


@dataclass
class KeyRegistry:
    """Catalog table ``name``: the key, the tuple ``cols`` and its hash.

    Made by ``create``; one that exists is opened by the class itself. One writer at a time. A load is
    appended as a whole by a single commit: a load that fails has registered all of its
    tuples or none, and repeating it finds them all known.
    """

    spark: SparkSession
    name: str
    key: str
    cols: tuple[str, ...]

    @classmethod
    def create(
        cls, spark: SparkSession, name: str, key: str, cols: Sequence[T.StructField], buckets: int, path: str | None = None
    ) -> KeyRegistry:
        """A new, empty registry in ``buckets`` buckets: so many that one of the full map fits a task
        (10^9 tuples of 100 bytes in 1,000 buckets: 100 MB each)."""
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
        location = f" LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE {name} (`{_HASH}` BIGINT, `{key}` BIGINT, {listed}) USING parquet"
            f" CLUSTERED BY (`{_HASH}`) SORTED BY (`{_HASH}`) INTO {buckets} BUCKETS{location}"
        )
        return cls(spark, name, key, tuple(f.name for f in cols))

    def read(self) -> DataFrame:
        """``(key, *cols)`` of all tuples ever registered."""
        return self.spark.table(self.name).select(self.key, *self.cols)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _buckets(self) -> int:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Num Buckets'")
        return int(rows.first()["data_type"])

    def _same(self, left: str, right: str) -> Column:
        """Tuples with one hash are told apart by their values, NULL like NULL.

        The hash is the only join key, so that the buckets serve: Spark would take
        null-safe equalities for further keys and shuffle both sides by all of them.
        """
        same = F.col(f"{left}.{_HASH}") == F.col(f"{right}.{_HASH}")
        for c in self.cols:
            a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
            same = same & F.when(a.isNull(), b.isNull()).otherwise(F.coalesce(a == b, F.lit(False)))
        return same

    def _hashed(self, tuples: DataFrame) -> DataFrame:
        """``tuples`` in the registry's own types, with their hash."""
        types = {f.name: f.dataType for f in self.read().schema}
        typed = tuples.select(*[F.col(c).cast(types[c]).alias(c) for c in self.cols])
        return typed.select(hash_key(self.cols).alias(_HASH), *self.cols)

    def unknown(self, tuples: DataFrame) -> DataFrame:
        """The tuples that the registry does not have; no row of the registry is shuffled."""
        known = self.spark.table(self.name)
        return self._hashed(tuples).hint("merge").alias("t").join(known.hint("merge").alias("r"), self._same("t", "r"), "left_anti")

    def register(self, df: DataFrame, scratch: Store | None = None) -> int:
        """Give every tuple of ``df`` a key that has none; how many there were."""
        scratch = scratch or workspace(self.spark)
        new = scratch.save("unknown", self.unknown(distinct_rows(df, self.cols)))
        n = new.count()
        if n:
            first = self.spark.table(self.name).agg(F.coalesce(F.max(self.key) + 1, F.lit(0))).first()[0]
            numbered = dense_key(new.select(*self.cols), self.key, self.cols, scratch)
            keyed = numbered.select(
                hash_key(self.cols).alias(_HASH), (F.col(self.key) + F.lit(first)).alias(self.key), *self.cols
            )
            # Written before it is appended: the append reads nothing that it changes.
            rows = scratch.save("new", keyed)
            rows.repartition(self._buckets(), _HASH).write.insertInto(self.name)
        return n

    def dimension(self, df: DataFrame) -> DataFrame:
        """``(key, *cols)`` of the tuples of ``df``, all of which must be registered."""
        known = self.spark.table(self.name).hint("merge").alias("r")
        found = self._hashed(distinct_rows(df, self.cols)).hint("merge").alias("t").join(known, self._same("t", "r"))
        return found.select(f"r.{self.key}", *[f"t.{c}" for c in self.cols])

    def extract_dim(self, df: DataFrame, scratch: Store | None = None) -> DataFrame:
        """``register``, then ``dimension``: like ``dims.extract_dim``, with keys that last."""
        self.register(df, scratch)
        return self.dimension(df)
