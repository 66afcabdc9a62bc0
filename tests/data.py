"""Rows in the layout of the raw files, with only the fields a test cares about spelled out."""

from playlake.schemas import LOG_FILE, SONG_FILE

_LOG = dict(
    artist="Elena", auth="Logged In", firstName="Lily", gender="F", itemInSession=0,
    lastName="Koch", length=269.58322, level="free", location="Chicago, IL", method="PUT",
    page="NextSong", registration=1.5e12, sessionId=1, song="Setanta matins", status=200,
    ts=1541106106796, userAgent="agent", userId="8",
)
_SONG = dict(
    song_id="S1", title="Setanta matins", artist_id="A1", artist_name="Elena",
    artist_location="Dubai UAE", artist_latitude=49.8, artist_longitude=-8.04,
    duration=269.58322, year=2004,
)


def log(spark, *rows):
    return spark.createDataFrame(
        [tuple({**_LOG, **r}[c] for c in LOG_FILE.fieldNames()) for r in rows], LOG_FILE
    )


def songs(spark, *rows):
    return spark.createDataFrame(
        [tuple({**_SONG, **r}[c] for c in SONG_FILE.fieldNames()) for r in rows], SONG_FILE
    )


def rows(df, *columns):
    """Rows as sorted tuples, None first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])
