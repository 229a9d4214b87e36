"""Databases, tables, table declarations, JDBC scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from starmart.spec import Column, Reference, Star


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def table_ddl(
    full_name: str,
    cols: Sequence[Column],
    key: str | None = None,
    references: Sequence[Reference] = (),
    widths: bool = False,
    format: str = "parquet",
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text.

    Spark does not enforce keys; they are recorded as table properties and tested
    by the checks. With ``widths`` texts become VARCHAR(n), and Spark then refuses
    longer values when the table is written.
    """
    lines = ",\n  ".join(
        f"{c.name} "
        + (f"VARCHAR({c.max_len})" if widths and c.max_len else c.spark_type.simpleString().upper())
        for c in cols
    )
    properties = {"primary_key": key} if key else {}
    properties |= {f"foreign_key.{r.column}": r.table for r in references}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    tail = f"\nTBLPROPERTIES ({listed})" if listed else ""
    return f"CREATE TABLE IF NOT EXISTS {full_name} (\n  {lines}\n) USING {format}{tail}"


def star_ddl(star: Star, database: str, widths: bool = False) -> list[str]:
    """One statement per table, referenced tables first."""
    return [
        table_ddl(
            f"{database}.{name}",
            star.table_columns(name),
            star.table(name).key,
            star.table(name).references,
            widths,
        )
        for name in star.write_order
    ]


def create_star_tables(
    spark: SparkSession, star: Star, database: str, widths: bool = False
) -> list[str]:
    for statement in star_ddl(star, database, widths):
        spark.sql(statement)
    return [f"{database}.{name}" for name in star.write_order]


def register_folder(
    spark: SparkSession, base: str, database: str, pattern: str = "%", suffix: str = ""
) -> list[str]:
    """Register each Parquet table below ``base`` whose name matches ``pattern``.

    ``%`` matches any text. Only metadata is read: Spark takes the schema from a
    footer and the data stays where it is. ``base`` may be on any file system
    that Spark reaches.
    """
    glob = f"{base.rstrip('/')}/{pattern.replace('%', '*')}{suffix}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    names = []
    for status in files or []:
        path = status.getPath()
        name = path.getName().removesuffix(suffix) if suffix else path.getName()
        if name.startswith(("_", ".")):
            continue
        full = f"{database}.{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet LOCATION '{path.toString()}'")
        names.append(full)
    return sorted(names)


def scan_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)


def peek(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> Mapping[str, str]:
    """Options of a JDBC scan, split into ``partitions`` range queries if asked to.

    Without a partition column the whole table comes through one connection.
    """
    result = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a split scan needs partition_column, lower, upper and partitions")
        result |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return result


def scan_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
