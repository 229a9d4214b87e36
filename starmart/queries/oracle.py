"""Building blocks of the checking SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def percent(col: str) -> str:
    return f"try_cast(try_cast(replace({col}, '%', '') AS DOUBLE) / 100 AS DECIMAL(3,2))"


def money(col: str) -> str:
    return f"try_cast(replace(replace({col}, '$', ''), ',', '') AS DECIMAL(10,2))"


def integer(col: str, type_: str = "INTEGER") -> str:
    """Text to integer, cutting decimals off."""
    return f"try_cast(trunc(try_cast(trim({col}) AS DECIMAL(38,6))) AS {type_})"


def codes(col: str, table: Mapping[str, object], default: str = "NULL") -> str:
    def literal(value: object) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    whens = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in table.items())
    return f"CASE {col} {whens} ELSE {default} END"


def flag(col: str, null_as: str = "0") -> str:
    return f"CASE WHEN {col} IS NULL THEN {null_as} WHEN {col} = 't' THEN 1 ELSE 0 END"


def member_bits(col: str, labels: Sequence[str]) -> str:
    bits = " || ".join(
        f"CASE WHEN {col} LIKE '%''{label}''%' THEN '1' ELSE '0' END" for label in labels
    )
    return f"CASE WHEN {col} IS NOT NULL THEN {bits} END"


def substring_bits(col: str, labels: Sequence[str]) -> str:
    bits = " || ".join(
        f"CASE WHEN instr({col}, '{label}') > 0 THEN '1' ELSE '0' END" for label in labels
    )
    return f"CASE WHEN {col} IS NOT NULL THEN {bits} END"


def half_bath(col: str, texts: Mapping[str, str], ignore_case: bool = True) -> str:
    subject = f"lower({col})" if ignore_case else col
    whens = " ".join(
        f"WHEN instr({subject}, '{k.lower() if ignore_case else k}') > 0 THEN '{v}'"
        for k, v in texts.items()
    )
    return f"CASE {whens} ELSE {col} END"


def before_blank(col: str) -> str:
    return f"CASE WHEN instr({col}, ' ') > 0 THEN substr({col}, 1, instr({col}, ' ') - 1) ELSE {col} END"


def after_blank(col: str) -> str:
    return f"CASE WHEN instr({col}, ' ') > 0 THEN substr({col}, instr({col}, ' ') + 1) END"


def rank_key(cols: Sequence[str]) -> str:
    """Dense key of a tuple: its place among the distinct tuples, NULLs first."""
    return f"dense_rank() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in cols)}) - 1"


def dim(source: str, cols: Sequence[str], key: str) -> str:
    listed = ", ".join(cols)
    return f"SELECT {rank_key(cols)} AS {key}, {listed} FROM (SELECT DISTINCT {listed} FROM ({source}) s) d"


def same(left: str, right: str, cols: Sequence[str]) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in cols)
