"""Typing a source in one pass that also keeps and counts what did not fit.

The pass that writes the typed copy carries the rejected values of each row along and has Spark
observe the counts on the way. The quarantine table is then read off the typed copy, one narrow
column of it, and the counts are there already: the source is scanned once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.casting import cast_column, number_text
from starmart.sources.store import Store, workspace
from starmart.spec import Column

_REJECTS = "_rejects"
_ENTRY = "struct<column_name:string,text:string,reason:string>"


@dataclass
class TypedLoad:
    """``clean`` has the typed rows, all of them; ``quarantine`` (row key, ``column_name, text,
    reason``) the values that became NULL or break the declaration; ``counts`` (``column_name,
    type, n_values, n_rejects``) how many, and ``n_rows`` the rows of the source."""

    clean: DataFrame
    quarantine: DataFrame
    counts: DataFrame
    n_rows: int


def _reason(name: str, source: T.DataType, declared: Column) -> tuple[SparkColumn, SparkColumn]:
    """The typed value, and why the given one is rejected; NULL if it is not."""
    given, target = F.col(name), declared.spark_type
    typed = cast_column(name, source, target)
    lost = given.isNotNull() & typed.isNull()
    if isinstance(target, T.NumericType):
        is_text = isinstance(source, T.StringType)
        why = F.when(number_text(given, "double").isNull(), "not a number").otherwise("out of range") if is_text else F.lit("out of range")
    elif isinstance(target, T.DateType | T.TimestampType | T.TimestampNTZType):
        why = F.lit("not a date")
    else:
        why = F.lit("does not fit")
    reason = F.when(lost, why)
    if not declared.nullable:
        reason = reason.when(given.isNull(), "missing")
    if declared.max_len is not None:
        # Such a text is kept as it is.
        reason = reason.when(F.length(given.cast("string")) > declared.max_len, "too wide")
    return typed, reason


def load_typed(
    df: DataFrame, schema: Iterable[Column], row_key: str, store: Store, name: str, scratch: Store | None = None
) -> TypedLoad:
    """Cast the columns of ``schema``, others pass through, and set aside what does not fit.

    Reasons: ``not a number``, ``out of range``, ``not a date``, ``does not fit`` (the value is NULL in
    ``clean``), ``missing`` (NULL in a required column), ``too wide`` (kept whole). ``row_key`` is given as in
    the source, so that rows whose key itself is rejected are found. Written are the typed copy to
    ``scratch`` and ``<name>_quarantine`` to ``store``.

    Counts are observed in the tasks that write the copy: a task that is repeated counts once.
    """
    declared = list(schema)
    scratch = scratch or workspace(df.sparkSession)
    sources = {f.name: f.dataType for f in df.schema}
    absent = [c.name for c in declared if c.name not in sources]
    if absent:
        raise ValueError(f"columns to cast are absent: {sorted(absent)}")
    both = {c.name: _reason(c.name, sources[c.name], c) for c in declared}
    entries = [
        F.when(reason.isNotNull(), F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("text"), reason.alias("reason")))
        for n, (_, reason) in both.items()
    ]
    rejects = F.array_compact(F.array(*entries)) if entries else F.array().cast(f"array<{_ENTRY}>")
    carried = df.select(
        F.col(row_key).alias("_row_key"),
        *[both[n][0].alias(n) if n in both else F.col(n) for n in df.columns],
        # NULL for most rows: next to nothing in a Parquet column.
        F.when(F.size(rejects) > 0, rejects).alias(_REJECTS),
        *[F.col(c.name).isNotNull().alias(f"_given_{i}") for i, c in enumerate(declared)],
    )
    seen = Observation()

    def rejected(column: str) -> SparkColumn:
        return F.exists(_REJECTS, lambda r: r["column_name"] == column)

    measures = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(declared):
        measures += [F.count_if(F.col(f"_given_{i}")).alias(f"n{i}"), F.count_if(rejected(c.name)).alias(f"r{i}")]
    observed = carried.observe(seen, *measures).select("_row_key", *df.columns, _REJECTS)
    copy = scratch.save(f"{name}_typed", observed)
    found = seen.get
    set_aside = copy.where(f"{_REJECTS} IS NOT NULL").select(F.col("_row_key").alias(row_key), F.inline(_REJECTS))
    quarantine = store.save(f"{name}_quarantine", set_aside)
    rows = [(c.name, c.type, found[f"n{i}"], found[f"r{i}"]) for i, c in enumerate(declared)]
    counts = df.sparkSession.createDataFrame(rows, "column_name string, type string, n_values bigint, n_rejects bigint")
    return TypedLoad(copy.select(*df.columns), quarantine, counts, found["rows"])


@dataclass
class Counting:
    """A store that observes how many rows each table got, in the tasks that write it."""

    store: Store
    rows: dict[str, int] = field(default_factory=dict)

    def save(self, name: str, df: DataFrame, replace: bool = False) -> DataFrame:
        seen = Observation()
        saved = self.store.save(name, df.observe(seen, F.count(F.lit(1)).alias("n")), replace)
        self.rows[name] = seen.get["n"]
        return saved

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return self.store.load(spark, name)
