"""Publishing all tables of a load at once.

A load writes its tables as a new version beside the old ones; nobody reads it yet. One row set
in the manifest, a Parquet table that is only appended to, then makes it the current version:
its tables are in a single file, which the commit of the append moves into place as a whole. A load that
fails before has changed nothing that readers see, and what it wrote is removed.

Works over folders and over catalog tables: a version is a folder below ``base``, or a suffix of
the table names in a database.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources.store import FolderStore, Store, TableStore

_MANIFEST = "version bigint, id string, state string, table_name string, published_at timestamp"
_PUBLISHED, _REMOVED = "published", "removed"


class NothingPublished(LookupError):
    """No version has been published, or it has no such table."""


@dataclass
class _Recording:
    """A store that notes which tables were written."""

    store: Store
    names: list[str]

    def save(self, name: str, df: DataFrame, replace: bool = False) -> DataFrame:
        if name not in self.names:
            self.names.append(name)
        return self.store.save(name, df, replace)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return self.store.load(spark, name)


@dataclass
class _SuffixedTables:
    """Tables ``database.name__id`` of one version."""

    tables: TableStore
    id: str

    def save(self, name: str, df: DataFrame, replace: bool = False) -> DataFrame:
        return self.tables.save(f"{name}__{self.id}", df, replace)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return self.tables.load(spark, f"{name}__{self.id}")


@dataclass
class Versions:
    """Versions of a set of tables below the folder ``base``, or in the catalog database
    ``database``, whose manifest lies at ``base`` in either case.

    One load at a time: of two that publish at once the one with the greater id becomes
    current, and both stay readable as versions.
    """

    spark: SparkSession
    base: str
    database: str | None = None

    def _store(self, id: str) -> Store:
        if self.database is None:
            return FolderStore(f"{self.base.rstrip('/')}/versions/{id}", "error")
        return _SuffixedTables(TableStore(self.database), id)

    @property
    def _manifest(self) -> str:
        return f"{self.base.rstrip('/')}/manifest"

    def manifest(self) -> DataFrame:
        """Every table of every version with the states it went through."""
        try:
            return self.spark.read.schema(_MANIFEST).parquet(self._manifest)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def _note(self, rows: list[tuple]) -> None:
        """Append ``rows`` (version, id, state, table) as one file: all are seen, or none."""
        noted = self.spark.createDataFrame(rows, "version bigint, id string, state string, table_name string")
        noted = noted.withColumn("published_at", F.current_timestamp()).coalesce(1)
        noted.write.mode("append").parquet(self._manifest)

    def history(self) -> list[tuple[int, str, list[str]]]:
        """``(version, id, tables)`` of all versions still there, the oldest first."""
        # One row per table of a load: small whatever the tables hold.
        rows = self.manifest().select("version", "id", "state", "table_name").collect()
        gone = {r["id"] for r in rows if r["state"] == _REMOVED}
        kept: dict[tuple[int, str], list[str]] = {}
        for r in rows:
            if r["id"] not in gone:
                kept.setdefault((r["version"], r["id"]), []).append(r["table_name"])
        return [(*key, sorted(names)) for key, names in sorted(kept.items())]

    @contextmanager
    def publishing(self) -> Iterator[Store]:
        """A store for one load. Its tables become current together when the block ends; if
        it raises, they are removed and the current version stays."""
        id = uuid.uuid4().hex
        recording = _Recording(self._store(id), [])
        try:
            yield recording
        except BaseException:
            self._drop(id, recording.names)
            raise
        if recording.names:
            before = max((v for v, _, _ in self.history()), default=0)
            self._note([(before + 1, id, _PUBLISHED, n) for n in recording.names])

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of the current version, or of ``version``. What one call returns
        belongs together, whatever is published meanwhile."""
        found = [h for h in self.history() if version in (None, h[0])]
        if not found:
            raise NothingPublished(f"no version {'' if version is None else version} at {self.base}")
        _, id, names = found[-1]
        store = self._store(id)
        return {n: store.load(self.spark, n) for n in names}

    def remove_old(self, keep: int = 1) -> list[int]:
        """Delete all but the last ``keep`` versions. First they are noted as removed, so no new
        reader starts on them; readers at work on one of them fail."""
        if keep < 1:
            raise ValueError("the current version must be kept")
        old = self.history()[:-keep]
        if old:
            self._note([(v, id, _REMOVED, n) for v, id, names in old for n in names])
        for _, id, names in old:
            self._drop(id, names)
        return [v for v, _, _ in old]

    def _drop(self, id: str, names: list[str]) -> None:
        store = self._store(id)
        if isinstance(store, FolderStore):
            store.drop(self.spark)
            return
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {store.tables.name(f'{name}__{id}')}")
