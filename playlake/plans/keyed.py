"""Lookup tables shaped for one question each: a write replaces the row with the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import full_name, to_float, to_id
from ..operators import enforce_required, last_per_key, with_artist
from ..schemas import (
    CONSOLIDATED_COLUMNS,
    SESSION_LIBRARY,
    SONG_LIBRARY,
    USER_ACTIVITY,
    Table,
)


def consolidate_events(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Event rows that name an artist, reduced to the columns the lookup tables need."""
    return with_artist(rows).select(*CONSOLIDATED_COLUMNS, *extra)


def _id(events: DataFrame, name: str):
    return to_id(name) if dict(events.dtypes)[name] == "string" else F.col(name).cast("bigint")


def _user() -> Column:
    """First and last name; a CSV scan reads a blank one as NULL, which leaves its part blank."""
    return full_name(*(F.coalesce(c, F.lit("")) for c in ("firstName", "lastName")))


def _keyed(
    events: DataFrame, table: Table, columns: dict, seq: Sequence[str], incomplete: str
) -> DataFrame:
    """The last row written per key.

    A row without a complete key fails the job; with ``incomplete='drop'`` it is left out.
    """
    order = {f"__seq{i}": F.col(c) for i, c in enumerate(seq)}
    rows = enforce_required(
        events.select(*(value.alias(name) for name, value in (columns | order).items())),
        table.required,
        incomplete,
    )
    return last_per_key(rows, table.key, list(order)).select(table.columns)


def session_library(events: DataFrame, seq: Sequence[str], incomplete: str = "raise") -> DataFrame:
    """What was played at each item of each session."""
    return _keyed(
        events,
        SESSION_LIBRARY,
        {
            "session_id": _id(events, "sessionId"),
            "item_in_session": _id(events, "itemInSession"),
            "artist": F.col("artist"),
            "song_title": F.col("song"),
            "song_length": to_float("length"),
        },
        seq,
        incomplete,
    )


def user_activity(events: DataFrame, seq: Sequence[str], incomplete: str = "raise") -> DataFrame:
    """What each user played in each session, by item."""
    return _keyed(
        events,
        USER_ACTIVITY,
        {
            "user_id": _id(events, "userId"),
            "session_id": _id(events, "sessionId"),
            "item_in_session": _id(events, "itemInSession"),
            "user": _user(),
            "artist": F.col("artist"),
            "song_title": F.col("song"),
        },
        seq,
        incomplete,
    )


def song_library(events: DataFrame, seq: Sequence[str], incomplete: str = "raise") -> DataFrame:
    """Who listened to each title."""
    return _keyed(
        events,
        SONG_LIBRARY,
        {
            "song_title": F.col("song"),
            "user_id": _id(events, "userId"),
            "user": _user(),
        },
        seq,
        incomplete,
    )


def lookup(
    rows: DataFrame, table: Table, select: Sequence[str], **key: object
) -> DataFrame:
    """Rows of one partition key, or of one full key, in clustering order.

    The equality filters reach the Parquet scan, where the layout of ``write_keyed`` lets
    them skip all but a few files.
    """
    named = set(key)
    if not set(table.partition_key) <= named or not named <= set(table.key):
        raise ValueError(f"{table.name} is looked up by {table.partition_key}, got {sorted(named)}")
    for name, value in key.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    rest = [c for c in table.clustering_key if c not in named]
    return (rows.orderBy(*rest) if rest else rows).select(*select)


def session_item(rows: DataFrame, session_id: int, item_in_session: int) -> DataFrame:
    """Artist, title and length heard at one item of a session."""
    return lookup(
        rows,
        SESSION_LIBRARY,
        ["artist", "song_title", "song_length"],
        session_id=session_id,
        item_in_session=item_in_session,
    )


def session_songs(rows: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """Artist, title and user name of a user's session, by item."""
    return lookup(
        rows,
        USER_ACTIVITY,
        ["artist", "song_title", "user"],
        user_id=user_id,
        session_id=session_id,
    )


def listeners(rows: DataFrame, song_title: str) -> DataFrame:
    """The names of everyone who listened to a title."""
    return lookup(rows, SONG_LIBRARY, ["user"], song_title=song_title)
