"""Queries over the driver's tables, each next to the SQL that must give the same rows."""

from . import cleaning, intake, load_values, lookups, modeling, moments, reporting, scans, upkeep, whole_loads  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
