"""Where tables are kept: a folder of Parquet tables, or a catalog database.

Both stores write a frame and hand back a frame that reads what was written, so
a caller that goes on with the result depends on files and not on the lineage
that made them. That is what keeps surrogate keys fixed once assigned.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from contextlib import suppress
from dataclasses import dataclass, field
from typing import Protocol

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


class Store(Protocol):
    def save(self, name: str, df: DataFrame, replace: bool = False) -> DataFrame:
        """Write ``df``; with ``replace`` in place of what this load wrote before."""

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        """The table as written."""


# For intermediate tables that are read whole: no statistics or checksums of pages, which take a
# seventh of the time that the clean copy of 69 columns takes to write.
UNSEARCHED = {"parquet.column.statistics.enabled": "false", "parquet.page.write-checksum.enabled": "false"}


@dataclass
class FolderStore:
    """One Parquet folder per table below ``base``."""

    base: str
    mode: str = "overwrite"
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def save(self, name: str, df: DataFrame, replace: bool = False) -> DataFrame:
        df.write.mode("overwrite" if replace else self.mode).options(**self.options).parquet(self.path(name))
        # The schema is known: no footer has to be opened to find it again.
        return df.sparkSession.read.schema(df.schema).parquet(self.path(name))

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))

    def drop(self, spark: SparkSession, name: str | None = None) -> None:
        """Delete one table, or the folder with all its tables."""
        _delete(self.base if name is None else self.path(name), spark._jsc.hadoopConfiguration())


def _delete(path: str, hadoop_configuration) -> None:
    at = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(hadoop_configuration).delete(at, True)


@dataclass
class TableStore:
    """Catalog tables ``database.name``. A table that exists keeps its declaration
    and has its rows replaced."""

    database: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def save(self, name: str, df: DataFrame, replace: bool = False) -> DataFrame:
        spark = df.sparkSession
        full = self.name(name)
        if spark.catalog.tableExists(full):
            declared = spark.table(full).columns
            if sorted(declared) != sorted(df.columns):
                raise ValueError(f"{full} has columns {declared}, the frame {df.columns}")
            df.select(*declared).write.insertInto(full, overwrite=True)
        else:
            df.write.format(self.format).options(**self.options).saveAsTable(full)
        return spark.table(full)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(self.name(name))


# Folders this process made for intermediate tables and has not removed yet, with the
# configuration by which they are reached: it outlives the session.
_OPEN: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session may name a folder of its own machine, or fall back to a
    temporary one, which goes when the process ends: on a cluster such a folder
    would be lost with its machine.
    """
    local = spark.sparkContext.master.startswith("local")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if named.startswith("file:") and not local:
            raise RuntimeError(f"spark.checkpoint.dir {named} is a folder of one machine")
        return named
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="starmart-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def owned(spark: SparkSession, path: str) -> str:
    """Have ``path`` removed by ``close_workspaces``, at the latest when the process ends."""
    _OPEN[path] = spark._jsc.hadoopConfiguration()
    return path


def workspace(spark: SparkSession) -> FolderStore:
    """A new store for intermediate tables in the shared folder.

    It belongs to this process: ``close_workspaces`` removes it, at the latest
    when the process ends, whether the session still runs or was stopped. Frames that read
    from it must be consumed before.
    """
    return FolderStore(owned(spark, f"{shared_dir(spark).rstrip('/')}/starmart/{uuid.uuid4().hex}"), "error")


@atexit.register
def close_workspaces() -> None:
    """Remove all workspaces of this process, and the folders its contexts checkpointed to."""
    while _OPEN:
        path, hadoop_configuration = _OPEN.popitem()
        # Without the JVM, or if the folder cannot be reached any more, it stays.
        with suppress(Py4JError, OSError):
            _delete(path, hadoop_configuration)
