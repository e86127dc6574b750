"""Imports every query module, so that the registry is complete."""

from bazaarlake.plans import cleaning, models, products, stores, streams, tables  # noqa: F401
from bazaarlake.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
