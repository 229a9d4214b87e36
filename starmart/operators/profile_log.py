"""Profiles that add up: a sketch per load and column, merged without reading any load again.

A load leaves one row per column: rows, values, the widest text, and an HLL sketch of the
values. Rows of any loads can be merged: counts add up, widths take the greatest, sketches are
united, so distinct counts are those of all loads together within the sketch's error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.profile import value_texts

# log2 of a sketch's registers; its relative standard error is about 1.04 / sqrt(2^n), here 1.6 %.
REGISTERS = 12
ERROR = 1.04 / 2 ** (REGISTERS / 2)

_ROWS = "column_name string, type string, n_rows bigint, n_non_null bigint, max_width bigint, sketch binary"


def sketch_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, type, n_rows, n_non_null, max_width, sketch)`` per column.

    One aggregate over one scan; a task sends a sketch of at most 4 kB a column, no values. NULL is
    no value; ``max_width`` is of texts only, NULL for other columns.
    """
    names = list(cols if cols is not None else df.columns)
    fields = [df.schema[n] for n in names]
    measures, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(fields):
        is_text = isinstance(f.dataType, T.StringType)
        width = F.max(F.length(f.name)) if is_text else F.lit(None)
        measures += [
            F.count(f.name).alias(f"n{i}"),
            width.cast("bigint").alias(f"w{i}"),
            F.hll_sketch_agg(f"v{i}", F.lit(REGISTERS)).alias(f"s{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"), F.col("n").alias("n_rows"),
                F.col(f"n{i}").alias("n_non_null"), F.col(f"w{i}").alias("max_width"), F.col(f"s{i}").alias("sketch"),
            )
        )
    return df.select("*", *value_texts(df, names)).agg(*measures).select(F.inline(F.array(*rows)))


def merged(sketches: DataFrame) -> DataFrame:
    """``(column_name, type, n_rows, n_non_null, n_distinct, max_width)`` of all loads together.

    A column whose type changed between loads has a row for each type.
    """
    return sketches.groupBy("column_name", "type").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_non_null").alias("n_non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"),
        F.max("max_width").alias("max_width"),
    )


@dataclass
class ProfileLog:
    """Profiles of loads below ``base``, a folder per load; adding a load again replaces it."""

    spark: SparkSession
    base: str

    def add(self, load: str, df: DataFrame, cols: Sequence[str] | None = None) -> None:
        sketch_profile(df, cols).coalesce(1).write.mode("overwrite").parquet(f"{self.base.rstrip('/')}/load={load}")

    def read(self) -> DataFrame:
        """The rows of all loads, with the load's name."""
        try:
            return self.spark.read.schema(f"{_ROWS}, load string").parquet(self.base)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{_ROWS}, load string")

    def profile(self, *loads: str) -> DataFrame:
        """The profile of ``loads`` together, of all if none is named; no load's data is read."""
        rows = self.read()
        return merged(rows.where(F.col("load").isin(*loads)) if loads else rows)
