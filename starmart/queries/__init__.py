"""Runnable queries over the test tables, each with the SQL that checks it."""

from starmart.queries import checks, dims, io, joins, listings, profiles, projections, texts
from starmart.queries.registry import ORACLE, QUERIES

__all__ = [
    "ORACLE",
    "QUERIES",
    "checks",
    "dims",
    "io",
    "joins",
    "listings",
    "profiles",
    "projections",
    "texts",
]
