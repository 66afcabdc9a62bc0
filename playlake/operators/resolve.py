"""Match plays to the catalog by title, artist name and length.

All are plain inner equi-joins: a missing title, artist or length matches nothing. No side
is forced into a broadcast; adaptive execution broadcasts the catalog when its measured
size allows, and otherwise splits the shuffle partition of a song with very many plays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (play column, catalog column)
MATCH = (("song", "title"), ("artist", "artist_name"), ("length", "duration"))


def _key(column: Column, name: str, scale: int | None) -> Column:
    if scale is not None and name in ("length", "duration"):
        return column.cast(f"decimal(18,{scale})")
    return column


def _on(log: str, catalog: str, scale: int | None) -> list[Column]:
    return [
        _key(F.col(f"{log}.{a}"), a, scale) == _key(F.col(f"{catalog}.{b}"), b, scale)
        for a, b in MATCH
    ]


def resolve_all(plays: DataFrame, catalog: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Each play once per matching song, with ``song_id`` and ``artist_id`` added.

    Lengths are compared exactly, or as decimals of ``scale`` places.
    """
    return (
        plays.alias("p")
        .join(catalog.alias("c"), _on("p", "c", scale), "inner")
        .select("p.*", "c.song_id", "c.artist_id")
    )


def first_matches(catalog: DataFrame, *, scale: int | None = None) -> DataFrame:
    """The catalog reduced to one song per match key, the smallest ``song_id``."""
    keys = [b for _, b in MATCH]
    return (
        catalog.select("song_id", "artist_id", *(_key(F.col(b), b, scale).alias(b) for b in keys))
        .groupBy(*keys)
        .agg(F.min(F.struct("song_id", "artist_id")).alias("hit"))
        .select(*keys, "hit.song_id", "hit.artist_id")
    )


def resolve_first(plays: DataFrame, catalog: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Each play with at most one matching song, the smallest ``song_id``.

    The catalog is reduced to one song per match key first, so copies of a song never
    multiply its plays.
    """
    return resolve_all(plays, first_matches(catalog, scale=scale), scale=scale)
