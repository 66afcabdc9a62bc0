"""Compare queries with their oracle SQL: python -m tests.check_oracle [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return db


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, db, sql: str) -> str | None:
    """None when both give the same columns and rows, else a description."""
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {name: str(kind) for name, kind in zip(columns, (d[1] for d in result.description))}
    actual = df.collect()
    mine, theirs = bag(df.columns, actual), bag(columns, expected)
    if mine != theirs:
        return (f"{len(actual)} rows, expected {len(expected)}; only here:"
                f" {list((mine - theirs).items())[:2]}; only there: {list((theirs - mine).items())[:2]}")
    if not expected:
        return "no rows on either side"
    spark_kinds = dict(df.dtypes)
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
    wrong = {n: (spark_kinds[n], kinds[n]) for n in columns if names.get(spark_kinds[n]) != kinds[n]}
    return f"types {wrong}" if wrong else None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).parent.parent))
    import __spark_entry__ as driver
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(driver.queries())
    spark, db, bad = session(), connect(sf_dir), 0
    for name in names:
        begun = time.time()
        try:
            df = driver.queries()[name](spark, sf_dir)
            sql = driver.oracle_sql().get(name)
            found = difference(df, db, sql) if sql else f"no oracle, {df.count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found)
        print(f"{time.time() - begun:6.2f}s {name}: {found or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
