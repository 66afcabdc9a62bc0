"""Column layouts and keys of every raw input and every output table.

Identifiers are ``bigint`` throughout: they hold the same values as a 32-bit
column, and do not overflow once there are billions of sessions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

CORRUPT = "_corrupt_record"
FAULT = "fault"  # why a row was not loaded


def layout(text: str) -> T.StructType:
    """A StructType from ``name type`` pairs, one per line."""
    pairs = (line.split() for line in text.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---------------------------------------------------------------------------
# Field names, types and positions of the raw files.

SONG_FILE = layout("""
    song_id string
    title string
    artist_id string
    artist_name string
    artist_location string
    artist_latitude double
    artist_longitude double
    duration double
    year int
""")

LOG_FILE = layout("""
    artist string
    auth string
    firstName string
    gender string
    itemInSession bigint
    lastName string
    length double
    level string
    location string
    method string
    page string
    registration double
    sessionId bigint
    song string
    status bigint
    ts bigint
    userAgent string
    userId string
""")

EVENT_CSV_COLUMNS = [
    "artist", "auth", "firstName", "gender", "itemInSession", "lastName",
    "length", "level", "location", "method", "page", "registration",
    "sessionId", "song", "status", "ts", "userId",
]

CONSOLIDATED_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
]

TEXT_WIDTH = 256
# ---------------------------------------------------------------------------

EVENT_CSV = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_CSV_COLUMNS])
CONSOLIDATED_CSV = T.StructType([T.StructField(c, T.StringType()) for c in CONSOLIDATED_COLUMNS])


@dataclass(frozen=True)
class Table:
    """An output table: its columns, its key and the columns that may not be null.

    ``partition_key`` and ``clustering_key`` are set on keyed lookup tables only;
    together they make up ``key``.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    partition_key: tuple[str, ...] = ()
    clustering_key: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def ddl(self) -> str:
        return ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + " NOT NULL" * (f.name in self.required)
            for f in self.schema
        )


SONGPLAY = Table(
    "songplay",
    layout("""
        songplay_id bigint
        start_time timestamp_ntz
        user_id bigint
        level string
        song_id string
        artist_id string
        session_id bigint
        location string
        user_agent string
    """),
    key=("songplay_id",),
    required=("start_time", "user_id", "level", "song_id", "artist_id", "session_id",
              "location", "user_agent"),
)

USERS = Table(
    "users",
    layout("""
        user_id bigint
        first_name string
        last_name string
        gender string
        level string
    """),
    key=("user_id",),
    required=("user_id", "first_name", "last_name", "gender", "level"),
)

SONG = Table(
    "song",
    layout("""
        song_id string
        title string
        artist_id string
        year int
        duration double
    """),
    key=("song_id",),
    required=("song_id", "title", "artist_id", "duration"),
)

ARTIST = Table(
    "artist",
    layout("""
        artist_id string
        name string
        location string
        latitude double
        longitude double
    """),
    key=("artist_id",),
    required=("artist_id", "name"),
)

TIME = Table(
    "time",
    layout("""
        start_time timestamp_ntz
        hour int
        day int
        week int
        month int
        year int
        weekday int
    """),
    key=("start_time",),
    required=("start_time", "hour", "day", "week", "month", "year", "weekday"),
)

SESSION = Table(
    "session",
    layout("""
        session_id bigint
        user_id bigint
        location string
        user_agent string
    """),
    key=("session_id",),
)

STAGING_EVENTS = Table(
    "staging_events",
    T.StructType([
        T.StructField(f.name, T.LongType() if f.name in ("registration", "userId") else f.dataType)
        for f in LOG_FILE
    ]),
    required=("itemInSession",),
)

#: Staged events with the number each one gets when it is staged.
STAGED_EVENTS = Table(
    "staging_events",
    T.StructType([T.StructField("event_id", T.LongType()), *STAGING_EVENTS.schema.fields]),
    key=("event_id",),
    required=("event_id", *STAGING_EVENTS.required),
)

# a song is known by its id: a line without one is no song
STAGING_SONGS = Table("staging_songs", SONG_FILE, required=("song_id",))

SESSION_LIBRARY = Table(
    "session_library",
    layout("""
        session_id bigint
        item_in_session bigint
        artist string
        song_title string
        song_length float
    """),
    key=("session_id", "item_in_session"),
    required=("session_id", "item_in_session"),
    partition_key=("session_id",),
    clustering_key=("item_in_session",),
)

USER_ACTIVITY = Table(
    "user_activity",
    layout("""
        user_id bigint
        session_id bigint
        item_in_session bigint
        user string
        artist string
        song_title string
    """),
    key=("user_id", "session_id", "item_in_session"),
    required=("user_id", "session_id", "item_in_session"),
    partition_key=("user_id", "session_id"),
    clustering_key=("item_in_session",),
)

SONG_LIBRARY = Table(
    "song_library",
    layout("""
        song_title string
        user_id bigint
        user string
    """),
    key=("song_title", "user_id"),
    required=("song_title", "user_id"),
    partition_key=("song_title",),
    clustering_key=("user_id",),
)

STAR = (USERS, ARTIST, SONG, TIME, SONGPLAY)
STAGING = (STAGING_EVENTS, STAGING_SONGS)
KEYED = (SESSION_LIBRARY, USER_ACTIVITY, SONG_LIBRARY)
