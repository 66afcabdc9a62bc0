"""Row filters and required-column checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRUPT

# Fixed value: the page of a log line that plays a song.
PLAY_PAGE = "NextSong"


def plays(log: DataFrame) -> DataFrame:
    """The log lines that play a song."""
    return log.filter(F.col("page") == PLAY_PAGE)


def known_users(log: DataFrame, user: str = "userId") -> DataFrame:
    """Drop lines without a user: NULL, or blank text."""
    if dict(log.dtypes)[user] == "string":
        return log.filter(F.col(user) != "")
    return log.filter(F.col(user).isNotNull())


def with_artist(rows: DataFrame, artist: str = "artist") -> DataFrame:
    """Drop rows without an artist: NULL (which is how a CSV scan reads a blank), or blank text."""
    return rows.filter(F.col(artist) != "")


def _complete(required: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in required), F.lit(True))


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all required columns set, the other rows)."""
    complete = _complete(required)
    return df.filter(complete), df.filter(~complete)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, malformed lines) of a scan that keeps corrupt records."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(
        F.col(CORRUPT).isNotNull()
    ).select(CORRUPT)


def enforce_required(df: DataFrame, required: Sequence[str], mode: str = "raise") -> DataFrame:
    """Apply NOT NULL rules as part of the plan.

    ``raise`` makes the job that writes the rows fail on the first NULL, without a check
    pass of its own; ``drop`` leaves incomplete rows out.
    """
    if mode == "drop":
        return split_valid(df, required)[0]
    if mode != "raise":
        raise ValueError(f"mode must be 'raise' or 'drop', not {mode!r}")
    types = dict(df.dtypes)
    return df.withColumns({
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} must not be null")).cast(types[c]))
        for c in required
    })
