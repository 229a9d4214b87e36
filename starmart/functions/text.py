"""Text cleaning as native column expressions.

Every function maps ``Column`` to ``Column`` with built-ins only, so a whole
cleaning step collapses into one code-generated projection. Unparseable input
gives NULL (``try_*``), never an error, and works the same with ANSI mode on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.operators.casting import number_text


def replace_text(col: Column, *finds: str) -> Column:
    """Remove every occurrence of each literal in ``finds``."""
    for find in finds:
        col = F.replace(col, F.lit(find), F.lit(""))
    return col


def percent_fraction(col: Column, type_: str = "decimal(3,2)") -> Column:
    """``'97%'`` -> 0.97."""
    return (number_text(replace_text(col, "%"), "double") / F.lit(100)).try_cast(type_)


def money(col: Column, type_: str = "decimal(10,2)", strip: Sequence[str] = ("$", ",")) -> Column:
    """``'$1,200.00'`` -> 1200.00. ``strip`` lists the literals to remove first."""
    return number_text(replace_text(col, *strip), type_)


def to_date(col: Column) -> Column:
    return col.try_cast("date")


def code_map(col: Column, codes: Mapping[str, object], default: object = None) -> Column:
    """Exact-match recode; values outside ``codes`` become ``default``."""
    chain = F
    for value, code in codes.items():
        chain = chain.when(col == F.lit(value), F.lit(code))
    return chain.otherwise(F.lit(default))


def when_contains(
    col: Column, texts: Mapping[str, str], ignore_case: bool = True
) -> Column:
    """Replace the value by the text of the first key it contains; else keep it."""
    haystack = F.lower(col) if ignore_case else col
    chain = F
    for find, text in texts.items():
        needle = find.lower() if ignore_case else find
        chain = chain.when(F.instr(haystack, needle) > 0, F.lit(text))
    return chain.otherwise(col)


def number_and_description(col: Column, type_: str = "decimal(5,1)") -> tuple[Column, Column]:
    """``'1.5 shared baths'`` -> (1.5, 'shared baths'): split at the first blank."""
    parts = F.split(col, " ", 2)
    return number_text(F.get(parts, F.lit(0)), type_), F.get(parts, F.lit(1))


def flag(col: Column, match: str = "exact", null_as: int | None = 0) -> Column:
    """``'t'`` -> 1, any other text -> 0, NULL -> ``null_as``.

    ``match="contains"`` counts every text with a ``t`` in it as true.
    """
    true = {"exact": col == F.lit("t"), "contains": F.contains(col, F.lit("t"))}[match]
    return F.when(col.isNull(), F.lit(null_as)).when(true, F.lit(1)).otherwise(F.lit(0)).cast("int")


def labels_to_bits(col: Column, labels: Sequence[str], match: str = "member") -> Column:
    """List text such as ``"['email', 'phone']"`` -> one 0/1 character per label.

    ``match="member"`` looks for whole list entries; ``"substring"`` for the label
    anywhere in the text, so that ``work_email`` also sets ``email``.
    """
    if match == "member":
        entries = F.translate(col, "[]'\" ", "")
        found = [F.find_in_set(F.lit(label), entries) > 0 for label in labels]
    elif match == "substring":
        found = [F.instr(col, label) > 0 for label in labels]
    else:
        raise ValueError(f"unknown match {match!r}")
    bits = F.concat(*[F.when(f, F.lit("1")).otherwise(F.lit("0")) for f in found])
    return F.when(col.isNotNull(), bits)


def sharing(col: Column, private: str = "private", shared: str = "shared") -> Column:
    """``private`` if the text says so, ignoring case; any other text is ``shared``; NULL stays."""
    says = F.contains(F.lower(col), F.lit(private.lower()))
    return F.when(says, F.lit(private)).when(col.isNotNull(), F.lit(shared))


def first_word_class(col: Column, classes: Mapping[str, str], default: str) -> Column:
    """Class by the first blank-separated word, ignoring case; else ``default``."""
    word = F.lower(F.substring_index(F.trim(col), " ", 1))
    lowered = {k.lower(): v for k, v in classes.items()}
    return F.when(col.isNotNull(), code_map(word, lowered, default))


def text_width(col: Column) -> Column:
    """Characters in the value's text form."""
    return F.length(col.cast("string"))
