"""Small projections that check their column names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename, refusing absent sources and names already taken."""
    absent = names.keys() - set(df.columns)
    if absent:
        raise ValueError(f"columns to rename are absent: {sorted(absent)}")
    renamed = [names.get(c, c) for c in df.columns]
    if len(set(renamed)) < len(renamed):
        raise ValueError(f"rename would duplicate a column: {dict(names)}")
    return df.withColumnsRenamed(dict(names))


def key_first(df: DataFrame, *keys: str) -> DataFrame:
    """Move the key columns to the front."""
    return df.select(*keys, *[c for c in df.columns if c not in keys])
