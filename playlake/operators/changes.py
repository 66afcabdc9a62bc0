"""The difference of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What changed from ``old`` to ``new``, rows with their number of copies ``n``.

    ``change`` is ``insert`` or ``delete`` where only one version has the key, else ``update_from``
    and ``update_to``. Rows are bags: a row that one version holds more often than the other is a
    change with the surplus. NULLs are equal, in keys too.

    Both versions are counted in one shuffle, in which equal rows cancel out map-side; only what is
    left meets its key again.
    """
    keys, columns = [*keys], old.columns
    signed = old.select(*columns, F.lit(-1).alias("__n")).union(new.select(*columns, F.lit(1).alias("__n")))
    left = signed.groupBy(*columns).agg(F.sum("__n").alias("n")).filter("n <> 0")
    held = signed.groupBy(*keys).agg(F.min("__n").alias("__low"), F.max("__n").alias("__high"))
    held = held.filter("__low < __high").select(*(F.col(k).alias(f"__{k}") for k in keys), F.lit(True).alias("__both"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    both, more = F.col("__both").isNotNull(), F.col("n") > 0
    change = (
        F.when(both & more, "update_to").when(both, "update_from").when(more, "insert").otherwise("delete")
    )
    return left.join(held, same, "left").select(change.alias("change"), *columns, F.abs("n").alias("n"))
