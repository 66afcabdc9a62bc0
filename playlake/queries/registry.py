"""Registration of queries together with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..settings import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; without ``sql`` only its rows are checked.

    The tables hold zone-free timestamps, so each query pins the session zone to UTC. It does so in a
    session of its own with the settings of the given one, which stays as it is.
    """

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own = spark.newSession()
            for name, value in spark.conf.getAll.items():
                if spark.conf.isModifiable(name):
                    own.conf.set(name, value)
            configure(own).conf.set("spark.sql.session.timeZone", "UTC")
            return build(own, sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLE[build.__name__] = sql
        return run

    return register
