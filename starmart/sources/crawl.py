"""Folders whose Parquet files were written with different schemas.

A load that changes a column's type leaves files that no single footer describes.
The crawl reads every file's footer in the tasks, reports what drifted, and
registers the folder under the narrowest types that hold all of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Digits before the point that Spark's reader asks of a decimal to read an integral column as one.
_READ_DIGITS = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}

# File systems that Arrow opens itself, by its own name of the scheme; only footers are read from these.
_ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}

_FOOTER = "path string, rows long, position int, column_name string, type string"


class SchemaConflictError(ValueError):
    """Columns of which no type holds the values of all files."""


def _footer_reader(schemes: dict[str, str]):
    """Reads footers of ``(path, content)``; without a content the file is opened by its path.

    All names stand inside, so that tasks need not find this package.
    """

    def read(batches):
        import json

        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type
        from pyspark.sql.types import StructType

        def metadata(path, content):
            if content is not None:
                return pq.read_metadata(pa.BufferReader(content))
            scheme, _, rest = path.partition(":")
            if scheme == "file":
                files, name = pa.fs.LocalFileSystem(), rest
            else:
                files, name = pa.fs.FileSystem.from_uri(f"{schemes[scheme]}:{rest}")
            with files.open_input_file(name) as opened:
                return pq.read_metadata(opened)

        def columns(found):
            written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            if written:
                return [(f.name, f.dataType.simpleString()) for f in StructType.fromJson(json.loads(written)).fields]
            named = []
            for field in found.schema.to_arrow_schema():
                try:
                    named.append((field.name, from_arrow_type(field.type).simpleString()))
                except Exception:  # noqa: BLE001  Spark has no such type: reported under Arrow's name, as a conflict
                    named.append((field.name, f"unknown {field.type}"))
            return named

        for batch in batches:
            rows = []
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = metadata(path, content)
                rows += [(path, found.num_rows, i, *column) for i, column in enumerate(columns(found))]
            names = ["path", "rows", "position", "column_name", "type"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
            values = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    return read


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``path, rows, position, column_name, type``: one row for each column of each Parquet file below ``path``.

    Files are listed by Spark and opened in the tasks, where only the footer is read. On a
    file system that Arrow does not know, Spark hands the tasks whole files
    instead, one after another. A file without columns gives no rows; a file that is no Parquet fails.
    """
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path)
    some = listed.select("path").first()
    if some is None:
        return spark.createDataFrame([], _FOOTER)
    known = some["path"].partition(":")[0] in _ARROW_SCHEMES
    # Without the content Spark reads no file; the tasks, planned by size, are put together.
    few = listed.select("path", F.lit(None).cast("binary")).coalesce(4 * spark.sparkContext.defaultParallelism)
    return (few if known else listed.select("path", "content")).mapInArrow(_footer_reader(_ARROW_SCHEMES), _FOOTER)


def widest(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both and in which Spark reads files of either; None if there is none.

    Integers widen to integers, DOUBLE (not BIGINT) and decimals; FLOAT to DOUBLE; decimals to decimals of up to
    38 digits; DATE to TIMESTAMP_NTZ; lists, maps and structs part by part, structs by field name.
    """
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merged_fields(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = widest(a.elementType, b.elementType)
        return item and T.ArrayType(item)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = widest(a.keyType, b.keyType), widest(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    for x, y in ((a, b), (b, a)):
        if type(x) in _INTEGRAL and type(y) in _INTEGRAL:
            return max(a, b, key=lambda t: _INTEGRAL.index(type(t)))
        if isinstance(y, T.DoubleType) and isinstance(x, T.ByteType | T.ShortType | T.IntegerType | T.FloatType):
            return y
        if isinstance(y, T.FloatType) and isinstance(x, T.ByteType | T.ShortType | T.IntegerType):
            return T.DoubleType()
        if isinstance(y, T.DecimalType) and isinstance(x, T.DecimalType | T.IntegralType):
            digits, scale = (x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_READ_DIGITS[type(x)], 0)
            whole, scale = max(digits, y.precision - y.scale), max(scale, y.scale)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    return None


def _merged_fields(a: T.StructType, b: T.StructType) -> T.StructType | None:
    fields = {f.name.lower(): (f.name, f.dataType) for f in a.fields}
    for f in b.fields:
        name, type_ = fields.get(f.name.lower(), (f.name, f.dataType))
        fields[f.name.lower()] = name, widest(type_, f.dataType)
    if any(t is None for _, t in fields.values()):
        return None
    return T.StructType([T.StructField(n, t) for n, t in fields.values()])


def _parsed(type_: str) -> T.DataType | None:
    return None if type_.startswith("unknown ") else T.DataType.fromDDL(type_)


def _versions(found: DataFrame) -> DataFrame:
    """One row for each column, by its name in lower case, and type."""
    return found.groupBy(F.lower("column_name").alias("name"), "type").agg(
        F.min("column_name").alias("column_name"),
        F.min("position").alias("position"),
        F.countDistinct("path").alias("files"),
        F.sum("rows").alias("rows"),
    )


def _reconciled(versions: Sequence) -> dict[str, tuple[str, T.DataType | None]]:
    """Lower-case name to column name and common type (None: a conflict), in the order of position and name.

    Types are merged in the order of their text, so that names inside structs do not depend on the files' order.
    """
    by_name: dict[str, list] = {}
    for v in versions:
        by_name.setdefault(v["name"], []).append(v)
    columns = {}
    for name, of in sorted(by_name.items(), key=lambda p: (min(v["position"] for v in p[1]), p[0])):
        types = [_parsed(v["type"]) for v in sorted(of, key=lambda v: v["type"])]
        merged = types[0]
        for t in types[1:]:
            merged = widest(merged, t) if merged is not None and t is not None else None
        columns[name] = min(v["column_name"] for v in of), merged
    return columns


def drift(spark: SparkSession, path: str) -> DataFrame:
    """``column_name, type, files, rows, common_type, missing_rows`` for each column and type in the files below ``path``.

    ``common_type`` is the type the column is registered with, NULL for a conflict;
    ``missing_rows`` counts the rows of files without the column. The driver gets one row for each
    column and type, however many files there are.
    """
    found = footers(spark, path).persist()
    try:
        versions = _versions(found).collect()
        total = found.select("path", "rows").distinct().agg(F.sum("rows")).first()[0] or 0
    finally:
        found.unpersist()
    columns = _reconciled(versions)
    have: dict[str, int] = {}
    for v in versions:
        have[v["name"]] = have.get(v["name"], 0) + v["rows"]
    rows = []
    for v in versions:
        name, common = columns[v["name"]]
        rows.append((name, v["type"], v["files"], v["rows"], common and common.simpleString(), total - have[v["name"]]))
    return spark.createDataFrame(
        rows, "column_name string, type string, files long, rows long, common_type string, missing_rows long"
    )


def crawl(
    spark: SparkSession, path: str, table: str, replace: bool = False, omit_conflicts: bool = False
) -> T.StructType:
    """Register the Parquet files below ``path`` as ``table`` (``database.name``) under one schema; return it.

    Each column has the type of ``widest`` over all files; files without it read as NULL. Only footers
    are read and the files stay as they are: Spark's reader widens while it scans. A column
    without a common type raises ``SchemaConflictError``, or is left out with ``omit_conflicts``. A
    table of that name is kept unless ``replace`` declares it anew. Names of folders are not read
    as partitions.
    """
    columns = _reconciled(_versions(footers(spark, path)).collect())
    conflicts = sorted(name for name, type_ in columns.values() if type_ is None)
    if conflicts and not omit_conflicts:
        raise SchemaConflictError(f"no type holds all files' values of {', '.join(conflicts)} in {path}")
    schema = T.StructType([T.StructField(name, type_) for name, type_ in columns.values() if type_ is not None])
    if not schema.fields:
        raise ValueError(f"no columns to register below {path}")
    if replace:
        # Declared with a location, so the files stay.
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    declared = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({declared}) USING parquet"
        f" OPTIONS (recursiveFileLookup 'true') LOCATION '{place}'"
    )
    return schema
