"""Delimited text in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources.store import Store, workspace

# Quotes inside quoted fields are doubled; fields may hold separators and newlines.
_QUOTED = {"header": True, "quote": '"', "escape": '"'}
_REJECT = "_rejected"
# Stands for "no text" in the reader when '' is a value; never part of a text.
_NO_TEXT = "\x00"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    multi_line: bool = True,
    keep_empty: bool = False,
    **options,
) -> DataFrame:
    """Read CSV with a header. Give a schema: without one Spark reads the data twice.

    Empty fields are NULL; with ``keep_empty`` a quoted empty field is ''.
    A file whose quoted fields may hold newlines cannot be split, so it is one
    task. For large inputs keep many files, or pass ``multi_line=False`` if no
    field holds a newline; then files are split like any other.
    """
    reader = spark.read.options(sep=sep, multiLine=multi_line, **_QUOTED).options(**options)
    if keep_empty:
        reader = reader.option("nullValue", _NO_TEXT)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "error", **options) -> None:
    """Write CSV for ``read_csv``. NULL is an empty field, '' a quoted one."""
    (
        df.write.mode(mode)
        .options(sep=sep, emptyValue='""', nullValue="", **_QUOTED)
        .options(**options)
        .csv(path)
    )


def load_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    name: str,
    store: Store,
    sep: str = ",",
    multi_line: bool = True,
    line_sep: str | None = "\n",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Bulk-load delimited text into table ``name``; return it and the rejected lines.

    Lines that do not parse into ``schema`` do not enter the table; their text is
    kept in ``<name>_rejected``. The text is parsed once, into splittable columnar
    files, from which both tables are taken.
    """
    full = T.StructType([*schema.fields, T.StructField(_REJECT, T.StringType())])
    extra = {"lineSep": line_sep} if line_sep else {}
    parsed = read_csv(
        spark,
        path,
        full,
        sep=sep,
        multi_line=multi_line,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_REJECT,
        **extra,
        **options,
    )
    scratch = workspace(spark)
    staged = scratch.save(name, parsed)
    good = staged.where(F.col(_REJECT).isNull()).drop(_REJECT)
    bad = staged.where(F.col(_REJECT).isNotNull()).select(F.col(_REJECT).alias("line"))
    loaded = store.save(name, good), store.save(f"{name}_rejected", bad)
    scratch.drop(spark)
    return loaded


