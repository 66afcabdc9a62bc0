"""Checks after a load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Table


def load_report(tables: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: rows, distinct keys, and rows with a NULL in the key.

    ``tables`` maps a name to the rows and their key columns. Keys are counted in two
    combined steps, first per key and then over keys.
    """

    def one(name: str, df: DataFrame, key: list[str]) -> DataFrame:
        blank = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key))
        per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
        return per_key.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(F.when(~blank, 1)).alias("key_count"),
            F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("null_keys"),
        )

    return reduce(
        DataFrame.unionByName, (one(name, df, key) for name, (df, key) in tables.items())
    )


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact keys that the dimension does not hold, with the number of fact rows.

    The fact is counted per key first, so the join sees each key once.
    """
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.join(dim.select(key), key, "left_anti")


def orphan_report(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension key: the number of fact rows without a match; expect zeros."""
    return reduce(
        DataFrame.unionByName,
        (
            orphans(fact, dim, key).agg(
                F.lit(key).alias("fact_key"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"),
            )
            for key, dim in dims.items()
        ),
    )


def schema_differences(df: DataFrame, table: Table) -> list[str]:
    """How the columns of ``df`` differ from the table's, in words; empty if they agree."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in table.schema}
    return [
        *(f"missing {n}" for n in want if n not in have),
        *(f"unexpected {n}" for n in have if n not in want),
        *(
            f"{n} is {have[n].simpleString()}, not {want[n].simpleString()}"
            for n in want
            if n in have and have[n] != want[n]
        ),
    ]


def column_report(df: DataFrame, table: Table) -> DataFrame:
    """Each column of a table: its place and type, whether the type is the declared one, and how many
    rows have a value in it. One scan for all columns."""
    want = {f.name: f.dataType for f in table.schema}
    filled = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)))
    columns = [
        F.struct(
            F.lit(table.name).alias("table_name"),
            F.lit(i + 1).alias("place"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(want.get(f.name) == f.dataType).alias("as_declared"),
            F.col(f"n{i}").alias("filled"),
        )
        for i, f in enumerate(df.schema)
    ]
    return filled.select(F.explode(F.array(*columns)).alias("c")).select("c.*")
