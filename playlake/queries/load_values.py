"""The whole loads compared by value: every table of a load as rows of one wide table, with the
name of the table in ``kind``. Song play ids, whose order is free, are left out."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import last_per_key
from ..plans import loads
from ..schemas import EVENT_CSV_COLUMNS
from ..streaming import load_activity_files
from ..workspace import scratch_path
from .modeling import _ARTIST_SQL
from .registry import query
from .roles import ARRIVAL, ARRIVAL_SQL_DESC, FACT_SQL, JSON_FILES, activity, catalog, raw_files, with_roles


def _wide(tables: Mapping[str, DataFrame]) -> DataFrame:
    named = [df.drop("songplay_id").select(F.lit(name).alias("kind"), "*") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def _wide_sql(ctes: str, **tables: str) -> str:
    parts = [f"SELECT '{name}' AS kind, * FROM ({sql})" for name, sql in tables.items()]
    return ctes + "\nUNION ALL BY NAME\n".join(parts)


def _time(moments: str, weekday: str) -> str:
    return f"""SELECT start_time, CAST(hour(start_time) AS INT) AS hour, CAST(day(start_time) AS INT) AS day,
       CAST(week(start_time) AS INT) AS week, CAST(month(start_time) AS INT) AS month,
       CAST(year(start_time) AS INT) AS year, CAST({weekday} AS INT) AS weekday FROM ({moments})"""


_SONGS = "SELECT {distinct} song_id, title, artist_id, year, duration FROM catalog"
_PLAYED = "SELECT make_timestamp({moment}) AS start_time FROM activity WHERE page = 'NextSong'"
_LATEST = """SELECT CAST(a.userId AS BIGINT) AS user_id, firstName AS first_name, lastName AS last_name, gender, level
FROM activity a JOIN (SELECT userId, max({moment}) AS latest FROM activity WHERE {where} GROUP BY userId) m
  ON m.userId = a.userId AND m.latest = {moment} WHERE {where}"""

_KEYED = {
    "users": """SELECT CAST(userId AS BIGINT) AS user_id, arg_min(firstName, (ts, sessionId, itemInSession)) AS first_name,
       arg_min(lastName, (ts, sessionId, itemInSession)) AS last_name, arg_min(gender, (ts, sessionId, itemInSession)) AS gender,
       arg_max(level, (ts, sessionId, itemInSession)) AS level
FROM activity WHERE page = 'NextSong' GROUP BY userId""",
    "time": _time(_PLAYED.format(moment="ts * 1000"), "isodow(start_time) - 1"),
    "songplay": """SELECT make_timestamp(ts * 1000) AS start_time, CAST(userId AS BIGINT) AS user_id, level,
       song_id, artist_id, sessionId AS session_id, location, userAgent AS user_agent
FROM activity a JOIN (SELECT title, artist_name, duration, min(song_id) AS song_id, arg_min(artist_id, song_id) AS artist_id
  FROM catalog GROUP BY ALL) c ON c.title = a.song AND c.artist_name = a.artist AND c.duration = a.length
WHERE page = 'NextSong'""",
}


def _loaded(spark: SparkSession, sf_dir: str, preset: str) -> DataFrame:
    tables = loads.load_star(
        spark,
        raw_files(spark, sf_dir, "catalog"),
        raw_files(spark, sf_dir, "activity"),
        scratch_path(spark, f"values-{preset}"),
        preset,
        pattern=JSON_FILES,
    )
    return _wide({name: df.drop("month") if name == "songplay" and preset == "lake" else df
                  for name, df in tables.items()})


@query(_wide_sql(
    with_roles("activity catalog", ""),
    song=_SONGS.format(distinct=""),
    artist=f"""SELECT * REPLACE (CAST(round(latitude) AS DOUBLE) AS latitude, CAST(round(longitude) AS DOUBLE) AS longitude)
    FROM (SELECT {_ARTIST_SQL} FROM (
      SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS n FROM catalog) WHERE n = 1)""",
    **_KEYED,
))
def load_keyed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, "keyed")


@query(_wide_sql(
    with_roles("activity catalog plays", ""),
    song=_SONGS.format(distinct="DISTINCT"),
    artist=f"SELECT DISTINCT {_ARTIST_SQL} FROM catalog",
    users=_LATEST.format(moment="ts // 1000", where="true"),
    time=_time("SELECT DISTINCT start_time FROM plays", "dayofweek(start_time)"),
    songplay=f"SELECT DISTINCT {FACT_SQL} FROM plays",
))
def load_warehouse_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, "warehouse")


@query(_wide_sql(
    with_roles("activity catalog plays", ""),
    song=_SONGS.format(distinct="DISTINCT"),
    artist=f"SELECT DISTINCT {_ARTIST_SQL} FROM catalog",
    users=_LATEST.format(moment="ts", where="page = 'NextSong'"),
    time=_time(_PLAYED.format(moment="ts // 1000 * 1000000"), "dayofweek(start_time) + 1"),
    songplay=f"SELECT {FACT_SQL}, CAST(year(start_time) AS INT) AS year FROM plays",
))
def load_lake_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, "lake")


@query(_wide_sql(
    with_roles("activity", f""", written AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY sessionId, itemInSession ORDER BY {ARRIVAL_SQL_DESC}) AS n
    FROM activity WHERE page = 'NextSong') WHERE n = 1)
"""),
    session_library="""SELECT sessionId AS session_id, itemInSession AS item_in_session, artist,
  song AS song_title, CAST(length AS FLOAT) AS song_length FROM written""",
    user_activity="""SELECT CAST(userId AS BIGINT) AS user_id, sessionId AS session_id,
  itemInSession AS item_in_session, firstName || ' ' || lastName AS user, artist, song AS song_title FROM written""",
    song_library="""SELECT DISTINCT song AS song_title, CAST(userId AS BIGINT) AS user_id,
  firstName || ' ' || lastName AS user FROM written""",
))
def load_lookups_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item of a session once, as the order of lines over several files is free."""
    log = activity(spark, sf_dir, *dict.fromkeys((*EVENT_CSV_COLUMNS, *ARRIVAL)), plays_only=True)
    source = scratch_path(spark, "values-csv")
    (last_per_key(log, ["sessionId", "itemInSession"], ARRIVAL).select(*EVENT_CSV_COLUMNS)
     .write.option("header", True).option("escape", '"').csv(source))
    return _wide(loads.load_lookup_tables(spark, source, scratch_path(spark, "values-lookups")))


@query(_wide_sql(with_roles("activity catalog", ""), **_KEYED))
def incremental_star_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, time and fact written batch by batch, two files each."""
    return _wide(load_activity_files(
        spark,
        raw_files(spark, sf_dir, "activity"),
        catalog(spark, sf_dir),
        scratch_path(spark, "values-incremental"),
        scratch_path(spark, "progress"),
        files_per_batch=2,
        pattern=JSON_FILES,
        buckets=16,
        spread=True,
    ))
