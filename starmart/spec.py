"""Declarative description of a star schema.

One ``Star`` is the single source for casts, table DDL, key columns, write order
and integrity checks, so those can never disagree with one another.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

_VARCHAR = re.compile(r"(?:var)?char\((\d+)\)", re.IGNORECASE)
_SPLIT_COLUMNS = re.compile(r",(?![^(]*\))")
_DECIMAL = re.compile(r"(?:decimal|numeric)(?:\((\d+)\s*,\s*(\d+)\))?", re.IGNORECASE)
_SIMPLE_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Column:
    """A typed column; ``max_len`` is the declared text width, if there is one."""

    name: str
    type: str
    max_len: int | None = None
    nullable: bool = True

    @property
    def spark_type(self) -> T.DataType:
        decimal = _DECIMAL.fullmatch(self.type)
        if decimal:
            return T.DecimalType(*map(int, decimal.groups())) if decimal[1] else T.DecimalType()
        return _SIMPLE_TYPES.get(self.type.lower()) or T.DataType.fromDDL(self.type)

    @property
    def field(self) -> T.StructField:
        return T.StructField(self.name, self.spark_type, self.nullable)


def columns(ddl: str) -> tuple[Column, ...]:
    """``"a bigint, b varchar(20)"`` -> columns; varchar(n) becomes string plus a width."""
    result = []
    for part in _SPLIT_COLUMNS.split(ddl):
        name, type_ = part.split(maxsplit=1)
        width = _VARCHAR.fullmatch(type_.strip())
        result.append(
            Column(name, "string", int(width[1])) if width else Column(name, type_.strip())
        )
    return tuple(result)


def struct_of(cols: Iterable[Column]) -> T.StructType:
    return T.StructType([c.field for c in cols])


@dataclass(frozen=True)
class Reference:
    """Foreign key ``column`` of the owning table, pointing at ``table``'s key.

    The key is found by all of ``table``'s attributes, or by those in ``on``.
    """

    column: str
    table: str
    on: tuple[str, ...] = ()


@dataclass(frozen=True)
class Dimension:
    """A deduplicated table.

    ``attributes`` are taken from the wide table. With ``natural_key`` the key is
    itself one of the wide table's columns; otherwise a surrogate is made. Tables
    named in ``references`` are sub-dimensions of this one (snowflake).
    """

    name: str
    key: str
    attributes: tuple[Column, ...]
    natural_key: bool = False
    references: tuple[Reference, ...] = ()

    @property
    def attribute_names(self) -> list[str]:
        return [c.name for c in self.attributes]


@dataclass(frozen=True)
class Star:
    """Dimensions plus the fact table, whose grain is one row per ``fact.key``."""

    dimensions: tuple[Dimension, ...]
    fact: Dimension

    def __post_init__(self) -> None:
        for table in self.dimensions:
            if table.references and not table.natural_key:
                raise ValueError(f"{table.name} has sub-dimensions and so needs a natural key")
        for table in (*self.dimensions, self.fact):
            for ref in table.references:
                target = self.table(ref.table)
                if target.natural_key and target.key != ref.column:
                    raise ValueError(f"{table.name}.{ref.column} must be named {target.key}")

    @cached_property
    def by_name(self) -> Mapping[str, Dimension]:
        return {t.name: t for t in (*self.dimensions, self.fact)}

    def table(self, name: str) -> Dimension:
        return self.by_name[name]

    @cached_property
    def write_order(self) -> list[str]:
        """Referenced tables before the tables that reference them."""
        order: list[str] = []

        def visit(table: Dimension, path: tuple[str, ...]) -> None:
            if table.name in path:
                raise ValueError(f"reference cycle: {' -> '.join((*path, table.name))}")
            if table.name in order:
                return
            for ref in table.references:
                visit(self.table(ref.table), (*path, table.name))
            order.append(table.name)

        leaves = [d for d in self.dimensions if not d.references]
        for table in (*leaves, *self.dimensions, self.fact):
            visit(table, ())
        return order

    def _foreign_key(self, ref: Reference) -> Column:
        """A foreign key has the type of the key it refers to: surrogates are BIGINT."""
        target = self.table(ref.table)
        types = {c.name: c.type for c in target.attributes}
        return Column(ref.column, types.get(target.key, "bigint"))

    def table_columns(self, name: str) -> tuple[Column, ...]:
        """Key, foreign keys, attributes: the columns as written."""
        table = self.table(name)
        attributes = {c.name: c for c in table.attributes}
        key = attributes.pop(table.key, Column(table.key, "bigint"))
        fks = [attributes.pop(r.column, self._foreign_key(r)) for r in table.references]
        required = Column(key.name, key.type, key.max_len, nullable=False)
        return (required, *(f for f in fks if f.name != table.key), *attributes.values())

    def table_schema(self, name: str) -> T.StructType:
        return struct_of(self.table_columns(name))

    def wide_attributes(self, name: str) -> list[str]:
        """Wide-table columns that determine a row of ``name``.

        Surrogate sub-dimensions count with their attributes, natural ones with
        their key.
        """
        found = list(self.table(name).attribute_names)
        for ref in self.table(name).references:
            natural = self.table(ref.table).natural_key
            found += [ref.column] if natural else self.wide_attributes(ref.table)
        return list(dict.fromkeys(found))

    def reachable_attributes(self, name: str) -> list[str]:
        """Attributes of ``name`` and of everything it refers to, directly or not."""
        found = list(self.table(name).attribute_names)
        for ref in self.table(name).references:
            found += self.reachable_attributes(ref.table)
        return list(dict.fromkeys(found))

    @cached_property
    def wide_columns(self) -> tuple[Column, ...]:
        """Every wide-table column the star reads, each once."""
        seen = {c.name: c for t in (self.fact, *self.dimensions) for c in t.attributes}
        return tuple(seen.values())
