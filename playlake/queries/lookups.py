"""Keyed lookup tables and the questions they answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import keyed
from ..schemas import SESSION_LIBRARY, SONG_LIBRARY, USER_ACTIVITY
from ..sources import read_parquet, write_keyed
from ..workspace import scratch_path
from .registry import query
from .roles import ARRIVAL, ARRIVAL_SQL_DESC, activity, with_roles


def _last_sql(name: str, key: str, columns: str) -> str:
    return f""", {name} AS (
  SELECT {columns} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ARRIVAL_SQL_DESC}) AS n
    FROM activity)
  WHERE n = 1)
"""


_SESSION_SQL = _last_sql(
    "session_library",
    "sessionId, itemInSession",
    "sessionId AS session_id, itemInSession AS item_in_session, artist, song AS song_title,"
    " CAST(length AS FLOAT) AS song_length",
)
_USER_SQL = _last_sql(
    "user_activity",
    "userId, sessionId, itemInSession",
    "CAST(userId AS BIGINT) AS user_id, sessionId AS session_id,"
    " itemInSession AS item_in_session, firstName || ' ' || lastName AS user, artist,"
    " song AS song_title",
)
_SONG_SQL = _last_sql(
    "song_library",
    "song, userId",
    "song AS song_title, CAST(userId AS BIGINT) AS user_id,"
    " firstName || ' ' || lastName AS user",
)


def _session_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.session_library(
        activity(spark, sf_dir, "artist", "song", "length", *ARRIVAL), ARRIVAL
    )


def _user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("artist", "song", "userId", "firstName", "lastName", *ARRIVAL)
    return keyed.user_activity(activity(spark, sf_dir, *columns), ARRIVAL)


def _song_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("song", "userId", "firstName", "lastName", *ARRIVAL)
    return keyed.song_library(activity(spark, sf_dir, *columns), ARRIVAL)


@query(with_roles("activity", _SESSION_SQL + "SELECT * FROM session_library"))
def session_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_library(spark, sf_dir)


@query(with_roles("activity", _SESSION_SQL + """
SELECT artist, song_title, song_length FROM session_library
WHERE session_id = 4 AND item_in_session = 6
"""))
def session_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.session_item(_session_library(spark, sf_dir), 4, 6)


@query(with_roles("activity", _SESSION_SQL + "SELECT * FROM session_library WHERE session_id = 4"))
def session_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of one session, from the stored table."""
    path = scratch_path(spark, "session_library")
    write_keyed(_session_library(spark, sf_dir), SESSION_LIBRARY, path)
    stored = read_parquet(spark, path, SESSION_LIBRARY.schema)
    return keyed.lookup(stored, SESSION_LIBRARY, SESSION_LIBRARY.columns, session_id=4)


@query(with_roles("activity", _USER_SQL + "SELECT * FROM user_activity"))
def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_activity(spark, sf_dir)


@query(with_roles("activity", _USER_SQL + """
, sessions AS (SELECT max(session_id) AS session_id FROM user_activity WHERE user_id = 10)
SELECT artist, song_title, user FROM user_activity
WHERE user_id = 10 AND session_id = (SELECT session_id FROM sessions)
"""))
def user_activity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The songs of a user's newest session, by item, from the stored table."""
    path = scratch_path(spark, "user_activity")
    write_keyed(_user_activity(spark, sf_dir), USER_ACTIVITY, path)
    stored = read_parquet(spark, path, USER_ACTIVITY.schema)
    newest = stored.filter("user_id = 10").agg(F.max("session_id")).first()[0]
    return keyed.session_songs(stored, 10, newest)


@query(with_roles("activity", _SONG_SQL + "SELECT * FROM song_library"))
def song_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _song_library(spark, sf_dir)


@query(with_roles("activity", _SONG_SQL + """
SELECT user FROM song_library WHERE song_title = 'blue bolt'
"""))
def song_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everyone who listened to one title, from the stored table."""
    path = scratch_path(spark, "song_library")
    write_keyed(_song_library(spark, sf_dir), SONG_LIBRARY, path, bloom=["song_title"])
    return keyed.listeners(read_parquet(spark, path, SONG_LIBRARY.schema), "blue bolt")
