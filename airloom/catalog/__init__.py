"""Registered queries and their SQL."""

from airloom.catalog import cleaning, flows, models, shaping, sources, spatial, storage  # noqa: F401
from airloom.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
