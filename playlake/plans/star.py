"""The star schema: song, artist, users and time dimensions, the songplay fact, sessions.

Inputs are catalog rows (layout ``SONG_FILE``) and log rows (layout ``LOG_FILE`` or
``STAGING_EVENTS``). Every builder is lazy and returns the columns of its table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import event_time, round_to_int, time_parts, to_id
from ..operators import (
    asof_join,
    distinct_rows,
    first_matches,
    first_per_key,
    known_users,
    latest_per_key,
    merge_fields,
    plays,
    resolve_all,
    resolve_first,
    surrogate_key,
)
from ..operators.clean import PLAY_PAGE
from ..operators.resolve import MATCH
from ..schemas import SESSION, SONG, SONGPLAY, TIME, USERS

ARRIVAL = ("ts", "sessionId", "itemInSession")


def songs(catalog: DataFrame, *, dedupe: bool = True) -> DataFrame:
    """Song dimension, whole-row distinct."""
    columns = catalog.select(SONG.columns)
    return columns.distinct() if dedupe else columns


def artist_columns(catalog: DataFrame, *, whole_coordinates: bool = False) -> DataFrame:
    """Catalog rows under the artist column names; coordinates rounded to ints if asked."""

    def coordinate(name: str):
        return round_to_int(name) if whole_coordinates else F.col(name)

    return catalog.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        coordinate("artist_latitude").alias("latitude"),
        coordinate("artist_longitude").alias("longitude"),
    )


def artists(
    catalog: DataFrame,
    *,
    one_per_id: bool = False,
    seq: Sequence[str] = ("song_id",),
    whole_coordinates: bool = False,
) -> DataFrame:
    """Artist dimension.

    Whole-row distinct keeps every spelling of an artist; ``one_per_id`` keeps the first
    row of each id in the order of ``seq``, which are catalog columns. ``whole_coordinates``
    rounds latitude and longitude to whole numbers, kept as doubles.
    """
    rows = first_per_key(catalog, ["artist_id"], seq) if one_per_id else catalog
    columns = artist_columns(rows, whole_coordinates=whole_coordinates)
    if whole_coordinates:
        columns = columns.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})
    return columns if one_per_id else distinct_rows(columns)


def _user_columns(log: DataFrame) -> list:
    user = F.col("userId") if dict(log.dtypes)["userId"] == "bigint" else to_id("userId")
    return [
        user.alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
    ]


def users_latest(
    log: DataFrame,
    *,
    precision: str = "s",
    ties: str = "all",
    tie_break: Sequence[str] = ("sessionId", "itemInSession"),
) -> DataFrame:
    """Users as of their latest log line.

    The caller decides which lines count: all pages, or plays only. Two lines at the same
    latest moment both stay unless ``ties='one'``; the moment is compared by second
    or, with ``precision='ms'``, by millisecond.
    """
    moment = F.call_function("div", "ts", F.lit(1000)) if precision == "s" else F.col("ts")
    return latest_per_key(
        known_users(log), "userId", moment, ties=ties, tie_break=("ts", *tie_break)
    ).select(_user_columns(log))


def user_states(log: DataFrame, seq: Sequence[str] = ARRIVAL) -> DataFrame:
    """One row per user that can still be merged: names as first seen, level as last seen.

    ``first_seq`` and ``last_seq`` remember when, so states of several batches combine to
    the same result in any order (``merge_user_states``).
    """
    seen = (
        known_users(log)
        .withColumns({"first_seq": F.struct(*seq), "last_seq": F.struct(*seq)})
        .select(*_user_columns(log), "first_seq", "last_seq")
        .filter(F.col("user_id").isNotNull())
    )
    return merge_user_states(seen)


def merge_user_states(states: DataFrame) -> DataFrame:
    return merge_fields(
        states,
        ["user_id"],
        first={"first_seq": ["first_name", "last_name", "gender"]},
        last={"last_seq": ["level"]},
    )


def users_upsert(log: DataFrame, seq: Sequence[str] = ARRIVAL) -> DataFrame:
    """Users with names from their first line and the level from their last one.

    The level is the most recent one even if a user went from free to paid and back:
    equal rows are not dropped before the merge, which would lose the way back.
    """
    return user_states(log, seq).select(USERS.columns)


def time_dimension(
    moments: DataFrame, column: str = "start_time", *, distinct: bool = True, style: str = "sun0"
) -> DataFrame:
    """Time dimension of a timestamp column.

    Distinct runs on the single timestamp before anything is derived from it.
    """
    start = moments.select(F.col(column).alias("start_time"))
    if distinct:
        start = start.distinct()
    return start.withColumns(time_parts("start_time", style)).select(TIME.columns)


def under_stored_artist(catalog: DataFrame, seq: Sequence[str] = ("song_id",)) -> DataFrame:
    """Catalog rows with the artist name that ``artists(one_per_id=True)`` keeps for their id.

    A spelling that only a later song of the artist has is not a name that plays are matched by.
    """
    stored = artists(catalog, one_per_id=True, seq=seq).select("artist_id", F.col("name").alias("artist_name"))
    return catalog.drop("artist_name").join(stored, "artist_id").select(catalog.columns)


def first_songs(catalog: DataFrame) -> DataFrame:
    """The one song that plays of a title, artist and length are matched to by ``match='first'``.

    To be stored where plays come in many batches, and matched by ``match='all'``: the catalog is
    then reduced once, not with every batch.
    """
    return first_matches(under_stored_artist(catalog))


def log_times(log: DataFrame, *, precision: str = "s") -> DataFrame:
    """The ``start_time`` of every log line."""
    return log.select(event_time("ts", precision).alias("start_time"))


def songplays(
    log: DataFrame,
    catalog: DataFrame,
    *,
    match: str = "all",
    dedupe: bool = False,
    precision: str = "s",
    scale: int | None = None,
) -> DataFrame:
    """The fact rows, without a surrogate key.

    ``match='all'`` gives one row per matching song, ``'first'`` at most one per play, matched by
    the name under which the artist is stored.
    ``dedupe`` drops rows equal in all columns, such as a repeat within one second.
    """
    resolve = {"all": resolve_all, "first": resolve_first}[match]
    if match == "first":
        catalog = under_stored_artist(catalog)
    if dedupe:
        # Copies of a song only repeat rows that would be dropped after the join.
        matched = ("song_id", "artist_id", *(b for _, b in MATCH))
        catalog = catalog.select(*matched).distinct()
    rows = songplay_columns(resolve(plays(log), catalog, scale=scale), precision)
    return rows.distinct() if dedupe else rows


def songplay_columns(resolved: DataFrame, precision: str = "s") -> DataFrame:
    """Resolved plays under the column names of the fact."""
    return resolved.select(
        event_time("ts", precision).alias("start_time"),
        _user_columns(resolved)[0],
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def keyed_songplays(
    fact: DataFrame,
    mode: str = "sparse",
    order: Sequence[str] | None = None,
    start: int = 1,
    scratch: str | None = None,
) -> DataFrame:
    """Fact rows with ``songplay_id``; see ``operators.surrogate_key`` for the modes."""
    return surrogate_key(
        fact, "songplay_id", mode, columns=order, start=start, scratch=scratch
    ).select(SONGPLAY.columns)


def with_year_month(fact: DataFrame) -> DataFrame:
    """Adds the ``year`` and ``month`` partition columns."""
    return fact.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})


def sessions(log: DataFrame) -> DataFrame:
    """Session dimension: the distinct user, location and agent of each session."""
    return (
        log.select(
            F.col("sessionId").alias("session_id"),
            _user_columns(log)[0],
            "location",
            F.col("userAgent").alias("user_agent"),
        )
        .distinct()
        .select(SESSION.columns)
    )


def sessions_by_gap(log: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The sessions that a log's times show: a user's lines none of which comes more than ``gap``
    after the one before. ``user_id``, first and last moment, lines, and plays among them.

    Lines are merged into sessions by each task before the shuffle (``configure``), so a user with
    very many lines reaches the next task as their sessions.
    """
    lines = known_users(log).select(
        _user_columns(log)[0], F.timestamp_millis("ts").alias("at"), event_time("ts", "ms").alias("moment"),
        (F.col("page") == PLAY_PAGE).cast("bigint").alias("play"),
    ).filter("user_id IS NOT NULL")
    return (
        lines.groupBy("user_id", F.session_window("at", gap))
        .agg(
            F.min("moment").alias("first_moment"),
            F.max("moment").alias("last_moment"),
            F.count("*").alias("lines"),
            F.sum("play").alias("plays"),
        )
        .drop("session_window")
    )


def level_at_plays(log: DataFrame, levels: DataFrame) -> DataFrame:
    """The plays of ``log`` with the ``level`` their user had then: that of the latest line of
    ``levels`` at or before them, NULL before the first one."""
    return asof_join(plays(log).drop("level"), levels, ["userId"], "ts", ["level"])
