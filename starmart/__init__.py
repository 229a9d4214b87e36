"""Dimensional warehousing on Spark: clean a wide table, split it into a star, check it, write it."""

from starmart.plans.star import build_star, denormalize
from starmart.spec import Column, Dimension, Reference, Star, columns

__all__ = ["Column", "Dimension", "Reference", "Star", "build_star", "columns", "denormalize"]
