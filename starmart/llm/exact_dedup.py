"""Exact duplicates by a persistent index of text digests.

The index is a table with one row per distinct text: its digest, the row that
stays and the size of its group. It is bucketed and sorted by digest. New rows
are reduced to one row per digest and joined to the index with a sort-merge
anti-join on the buckets, which shuffles no index row; what is not found is
appended in the same buckets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import join_hot, keep, lower_ascii, take_rows
from starmart.sources.store import workspace


def digest(text):
    """SHA-256 of the text in UTF-8, A-Z lower-cased; NULL counts as empty."""
    return F.sha2(lower_ascii(text), 256)


@dataclass
class DigestIndex:
    """The digests of all texts seen so far: catalog table ``name``, files at ``path``.

    ``buckets`` is fixed when the index is made: choose it so that a bucket of the
    full index fits a task (at 100 TB some 10^10 digests, so 10^4 buckets hold
    10^6 rows, 100 MB, each).
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, name: str, path: str, buckets: int, id_type: str = "bigint") -> DigestIndex:
        """A new, empty index; one that exists is opened by the class itself."""
        spark.sql(
            f"CREATE TABLE {name} (digest STRING, keep STRUCT<id: {id_type}, row: BIGINT>, group_size BIGINT)"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, name, path, buckets)

    @classmethod
    def temporary(cls, spark: SparkSession, id_type: str = "bigint") -> DigestIndex:
        """An empty index in the shared folder; ``drop`` it, or a lasting catalog keeps its name."""
        name = f"digests_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls.create(spark, name, workspace(spark).path(name), buckets, id_type)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Take the table out of the catalog; the files stay at ``path``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups``, one per digest, that the index does not have."""
        known = self.read().select("digest")
        return groups.hint("merge").join(known.hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add ``(digest, keep, group_size)``; digests must be new and distinct."""
        dealt = groups.select("digest", "keep", "group_size").repartition(self.buckets, "digest")
        dealt.write.insertInto(self.name)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, id, digest)`` of every row, written: the only pass over the texts.

    ``row`` tells apart rows that agree in everything; it is fixed by the writing.
    """
    row = F.monotonically_increasing_id()
    return keep(docs.select(row.alias("row"), F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest")))


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays (largest id, NULL last) and how many there are."""
    last = F.max(F.struct("id", "row")).alias("keep")
    return rows.groupBy("digest").agg(last, F.count(F.lit(1)).alias("group_size"))


def deduplicate(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Report on every row of ``rows`` (see ``digests``) and add its texts to ``index``.

    ``doc_id, keep_id, group_size, kept, text_sha256``. Of the rows with one digest
    that with the largest id stays, unless the index had the digest before: then
    none stays, and ``keep_id`` and ``group_size`` are those of the index. Rows alike
    in id and text are one group like any other, of which one row stays. A NULL id
    loses to any other; ``keep_id`` is NULL only where all ids of a group are.

    A batch that is run twice against a kept index has all its texts there already, so none of its rows
    stays: whoever repeats a batch starts from the index as it was.

    The groups are written before they meet the index, so the append reads no
    table that it changes. A group that holds a third of all rows collapses before
    it is shuffled, and its rows are split when they get their group back.
    """
    found = keep(groups_of(rows))
    new = keep(index.unseen(found).withColumn("new", F.lit(True)))
    index.append(new)
    marked = found.select("digest").join(new.select("digest", "new"), "digest", "left")
    stays = index.read().join(marked, "digest")
    joined = join_hot(rows, stays, "digest")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.coalesce("new", F.lit(False)) & (F.col("row") == F.col("keep.row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ties leave one row."""
    rows = digests(docs, doc_id, text)
    index = DigestIndex.temporary(docs.sparkSession, rows.schema["id"].dataType.simpleString())
    # Written first: Spark would move the join below the grouping, onto rows of hot groups.
    index.append(index.unseen(keep(groups_of(rows))))
    stays = index.read().select("digest", F.col("keep.id").alias("id"))
    counted = rows.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("rows"))
    same = (F.col("s.digest") == F.col("n.digest")) & F.col("s.id").eqNullSafe(F.col("n.id"))
    picks = stays.alias("s").join(counted.alias("n"), same)
    picks = picks.select("s.id", F.col("s.digest").alias("mark"), "n.rows", F.lit(1).alias("copies"))
    picks = keep(picks)
    index.drop()
    return take_rows(docs, picks, doc_id, digest(F.col(text)))
