"""Play reports and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import event_time, to_id
from ..operators import known_users, plays, resolve_all
from ..plans import quality, reports, star
from .modeling import PLAY_COLUMNS
from .registry import query
from .roles import FACT_SQL, activity, catalog, event_log, table, with_roles

MATCH_COLUMNS = ("artist", "song", "length", "page")


def counts(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    """Play counts per song, for the reports that need no single play."""
    log = activity(spark, sf_dir, *MATCH_COLUMNS, *by, plays_only=True)
    return reports.play_counts(log, catalog(spark, sf_dir), by)


_FIRST_ARTIST_SQL = """, artist AS (
  SELECT artist_id, min(artist_name) AS name FROM catalog GROUP BY artist_id)
, song AS (SELECT song_id, min(title) AS title FROM catalog GROUP BY song_id)
"""


def fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Resolved plays with only the columns a report needs; those of the match come along."""
    log = activity(spark, sf_dir, *MATCH_COLUMNS, *columns, plays_only=True)
    return resolve_all(plays(log), catalog(spark, sf_dir))


@query(with_roles("activity catalog plays", _FIRST_ARTIST_SQL + """
SELECT artist_id, name, plays FROM (
  SELECT artist_id, count(*) AS plays FROM plays GROUP BY artist_id
  ORDER BY count(*) DESC, artist_id LIMIT 5) JOIN artist USING (artist_id)
"""))
def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = star.artist_columns(catalog(spark, sf_dir))
    return reports.top_artists(counts(spark, sf_dir), artists)


@query(with_roles("activity catalog plays", _FIRST_ARTIST_SQL + """
SELECT song_id, title, plays FROM (
  SELECT song_id, count(*) AS plays FROM plays GROUP BY song_id
  ORDER BY count(*) DESC, song_id LIMIT 5) JOIN song USING (song_id)
"""))
def top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_songs(counts(spark, sf_dir), star.songs(catalog(spark, sf_dir), dedupe=False))


def _by_country_sql(key: str, dim: str, label: str) -> str:
    return with_roles("activity catalog plays", _FIRST_ARTIST_SQL + f"""
SELECT location, CAST(pos AS INTEGER) AS pos, {key}, {label}, plays FROM (
  SELECT location, {key}, count(*) AS plays,
         row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, {key}) AS pos
  FROM plays GROUP BY location, {key}) JOIN {dim} USING ({key})
WHERE pos <= 5
""")


@query(_by_country_sql("artist_id", "artist", "name"))
def top_artists_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = star.artist_columns(catalog(spark, sf_dir))
    return reports.top_artists_by_country(counts(spark, sf_dir, "location"), artists)


@query(_by_country_sql("song_id", "song", "title"))
def top_songs_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = star.songs(catalog(spark, sf_dir), dedupe=False)
    return reports.top_songs_by_country(counts(spark, sf_dir, "location"), songs)


@query(with_roles("activity catalog plays", """
SELECT count(DISTINCT user_id) AS number_of_paid_users FROM plays
WHERE level = 'paid' AND month(start_time) = 6 AND year(start_time) = 1998
"""))
def paid_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact(spark, sf_dir, "ts", "userId", "level").select(
        event_time("ts").alias("start_time"), to_id("userId").alias("user_id"), "level"
    )
    return reports.paid_users(rows, 1998, 6)


@query(with_roles("activity catalog plays", f"""
SELECT {FACT_SQL} FROM plays
ORDER BY start_time, session_id, item_in_session, song_id, supp_key LIMIT 5
"""))
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five songplays."""
    extra = [c for c in PLAY_COLUMNS if c not in MATCH_COLUMNS]
    rows = fact(spark, sf_dir, *extra, "itemInSession", "suppKey")
    first = reports.preview(rows, ["ts", "sessionId", "itemInSession", "song_id", "suppKey"])
    return star.songplay_columns(first)


@query(with_roles("event_log", """
SELECT DISTINCT TRY_CAST(userId AS BIGINT) AS user_id, level FROM event_log WHERE userId <> ''
ORDER BY user_id, level LIMIT 5
"""))
def preview_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = known_users(event_log(spark, sf_dir)).select(to_id("userId").alias("user_id"), "level")
    return reports.preview(users.distinct(), ["user_id", "level"])


@query(with_roles("catalog", """
SELECT song_id, title, artist_id, year, duration FROM catalog ORDER BY song_id LIMIT 5
"""))
def preview_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.preview(star.songs(catalog(spark, sf_dir)), ["song_id"])


@query(with_roles("catalog", """
SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
       artist_latitude AS latitude, artist_longitude AS longitude
FROM catalog ORDER BY artist_id, location LIMIT 5
"""))
def preview_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.preview(star.artists(catalog(spark, sf_dir)), ["artist_id", "location"])


@query("""
SELECT DISTINCT l_shipdate AS start_time, CAST(0 AS INTEGER) AS hour,
       CAST(day(l_shipdate) AS INTEGER) AS day, CAST(week(l_shipdate) AS INTEGER) AS week,
       CAST(month(l_shipdate) AS INTEGER) AS month, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(dayofweek(l_shipdate) AS INTEGER) AS weekday
FROM lineitem ORDER BY start_time LIMIT 5
""")
def preview_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = star.time_dimension(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return reports.preview(times, ["start_time"])


_COUNT_SQL = """
SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(DISTINCT {key}) AS BIGINT) AS key_count,
       CAST(count(*) - count({key}) AS BIGINT) AS null_keys FROM {rows}
"""


@query(with_roles("activity catalog plays event_log", " UNION ALL ".join([
    _COUNT_SQL.format(name="song", key="song_id", rows="catalog"),
    _COUNT_SQL.format(name="artist", key="artist_id", rows=(
        "(SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude,"
        " artist_longitude FROM catalog)")),
    _COUNT_SQL.format(name="users", key="user_id", rows=(
        "(SELECT TRY_CAST(userId AS BIGINT) AS user_id FROM event_log)")),
    _COUNT_SQL.format(name="time", key="ts", rows="activity"),
    _COUNT_SQL.format(name="songplay", key="session_id", rows="plays"),
])))
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog(spark, sf_dir)
    return quality.load_report({
        "song": (rows, ["song_id"]),
        "artist": (star.artists(rows), ["artist_id"]),
        "users": (event_log(spark, sf_dir).select(to_id("userId").alias("user_id")), ["user_id"]),
        "time": (activity(spark, sf_dir, "ts"), ["ts"]),
        "songplay": (fact(spark, sf_dir, "sessionId"), ["sessionId"]),
    })


@query(with_roles("activity catalog plays", """
SELECT 'song_id' AS fact_key, CAST(count(*) AS BIGINT) AS orphans FROM plays p
WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.song_id = p.song_id AND c.year > 10)
UNION ALL
SELECT 'artist_id', CAST(count(*) AS BIGINT) FROM plays p
WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.artist_id = p.artist_id)
"""))
def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows without their song, in a song table lacking early years, and without artist."""
    rows = catalog(spark, sf_dir)
    return quality.orphan_report(
        fact(spark, sf_dir),
        {"song_id": rows.filter("year > 10"), "artist_id": star.artists(rows)},
    )
