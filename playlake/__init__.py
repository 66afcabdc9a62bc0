"""Spark-first play analytics: raw catalog and activity files to star schema, keyed tables and reports."""

from .settings import configure

__all__ = ["configure"]
