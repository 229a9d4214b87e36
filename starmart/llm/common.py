"""What the operators share: checkpoints, whole-row selection, joins on hot keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources.store import owned, shared_dir

# White space of the contracts: blank, tab to carriage return. Words are what is left.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and go on from there.

    What was written does not change when an executor is lost. Spark removes the
    files once nothing refers to them, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set; without it the
    context's own checkpoint folder goes with the workspaces, when the process ends.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    # A folder of this context alone, below the one that was named.
    owned(df.sparkSession, context.getCheckpointDir())
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names that do not clash with ``taken``, whatever its case."""
    used = {c.lower() for c in taken}
    made = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        made.append(name)
    return made


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key``, which may be hot in ``left`` and is unique in ``right``.

    Where ``right`` comes out of an aggregation on the same key, Spark would reuse
    its partitioning, and adaptive execution cannot split the hot partition of a
    side it did not shuffle for the join. The hash as a second key has both sides
    dealt anew, so that it can.
    """
    (name,) = fresh([*left.columns, *right.columns], "_dealt")
    dealt = F.xxhash64(F.col(key))
    return left.withColumn(name, dealt).join(right.withColumn(name, dealt), [key, name], how).drop(name)


def take_rows(docs: DataFrame, picks: DataFrame, key_id: str, mark: Column) -> DataFrame:
    """The rows of ``docs`` that ``picks`` names, each as often as it says.

    ``picks`` is checkpointed and has one row per (id, mark), NULL ids included:
    ``id``, ``mark``, ``rows`` (rows of ``docs`` with that id and mark) and
    ``copies``. Rows that agree in both are interchangeable: one of them stands
    for all. The text is shuffled once; ``docs`` keeps its columns.
    """
    m, i, r, n, one = fresh(docs.columns, "_mark", "_id", "_rows", "_copies", "_one")
    named = picks.select(
        F.col("id").alias(i), F.col("mark").alias(f"{m}_"), F.col("rows").alias(r), F.col("copies").alias(n)
    ).where(F.col(n) > 0)
    same = (F.col(m) == F.col(f"{m}_")) & F.col(key_id).eqNullSafe(F.col(i))
    marked = docs.withColumn(m, mark)
    found = marked.join(named.where(F.col(r) == 1), same)
    if not picks.where("rows > 1 AND copies > 0").isEmpty():
        repeated = marked.join(named.where(F.col(r) > 1), same)
        found = found.unionByName(repeated.dropDuplicates([m, i]))
    many = F.explode(F.array_repeat(F.lit(1), F.col(n).cast("int"))).alias(one)
    return found.select(*docs.columns, many).drop(one)


def whole(batches: Iterable, column: str) -> Iterator[tuple]:
    """(batch, texts as Python strings, NULL as empty) of Arrow batches."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
