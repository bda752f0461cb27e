"""Registered queries over the test tables, each with its DuckDB equivalent."""

from corpuslm.catalog import classification, features, ingest, preparation  # noqa: F401  (they register)
from corpuslm.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
