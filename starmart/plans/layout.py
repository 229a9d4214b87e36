"""A star laid out for its largest join.

Dimensions are written bucketed and sorted by key, the fact by its foreign key into the largest of
them, in as many buckets: joining the two back reads buckets side by side and shuffles
nothing. Rows of hot keys, which would fill single buckets, are kept in a table of their own that is
dealt evenly and joined with the few dimension rows they refer to by broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.dims import frequent_shares
from starmart.operators.keys import hash_key
from starmart.plans.star import denormalize
from starmart.spec import Star

# A key is hot from this part of a bucket's mean rows on: so there are 4 a bucket at most, and
# as many dimension rows are broadcast.
_PARTS = 4


@dataclass
class BucketedStar:
    """Tables ``database.name`` of a star, its fact bucketed by the reference into ``largest``.

    ``buckets`` is fixed when the star is written: so many that a bucket of the fact fits a task.
    """

    star: Star
    spark: SparkSession
    database: str
    largest: str
    buckets: int

    def __post_init__(self) -> None:
        into = [r.column for r in self.star.fact.references if r.table == self.largest]
        if len(into) != 1:
            raise ValueError(f"{self.star.fact.name} has {len(into)} references to {self.largest}, not one")
        (self.column,) = into

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    @property
    def _hot(self) -> str:
        return f"{self.star.fact.name}_hot"

    def _write(self, df: DataFrame, name: str, by: str) -> None:
        # Dealt by the bucket's column first: each task writes the files of its own buckets only.
        dealt = df.repartition(self.buckets, by)
        dealt.write.mode("overwrite").bucketBy(self.buckets, by).sortBy(by).format("parquet").saveAsTable(self.name(name))

    def save(self, tables: Mapping[str, DataFrame]) -> None:
        """Write the tables of a load (``build_star``) in this layout; the fact goes last."""
        for spec in self.star.dimensions:
            self._write(tables[spec.name], spec.name, spec.key)
        fact = tables[self.star.fact.name]
        hot = frequent_shares(fact, {"hot": [self.column]}, 1 / (_PARTS * self.buckets))["hot"]
        keys = F.broadcast(self.spark.createDataFrame([(h,) for h in hot], "_hot long"))
        hashed = hash_key([self.column]) == F.col("_hot")
        self._write(fact.join(keys, hashed, "left_anti"), self.star.fact.name, self.column)
        dealt = fact.join(keys, hashed, "left_semi")
        dealt.write.mode("overwrite").format("parquet").saveAsTable(self.name(self._hot))

    def tables(self) -> dict[str, DataFrame]:
        """The tables as written; the fact has its hot rows, too."""
        found = {n: self.spark.table(self.name(n)) for n in self.star.write_order}
        fact = self.star.fact.name
        found[fact] = found[fact].unionByName(self.spark.table(self.name(self._hot)))
        return found

    def denormalize(self) -> DataFrame:
        """The wide table: the fact joined back with everything it refers to.

        The join with the largest reference meets buckets, without a shuffle of either side; the
        others are as in ``plans.star.denormalize``. Hot rows meet the dimension rows of hot keys only.
        """
        dims = {n: self.spark.table(self.name(n)) for n in self.star.write_order}
        fact = self.star.fact.name
        cool = denormalize(self.star, dims, bucketed=self.largest)
        hot = self.spark.table(self.name(self._hot))
        key = self.star.table(self.largest).key
        # As few as were found when the fact was written; combined in the tasks.
        few = hot.select(F.col(self.column).alias(key)).distinct()
        hot_dims = {**dims, fact: hot, self.largest: dims[self.largest].join(F.broadcast(few), key, "left_semi")}
        return cool.unionByName(denormalize(self.star, hot_dims, broadcast=self.largest))
