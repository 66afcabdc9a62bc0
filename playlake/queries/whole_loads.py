"""Loads from raw files to written tables, in one go and file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import plays
from ..plans import loads, quality
from ..schemas import KEYED, LOG_FILE, STAGING_EVENTS, STAR
from ..sources import log_faults, refuse_faults
from ..streaming import (
    append_batch,
    each_new_file,
    load_activity_files,
    merge_users_batch,
    read_batches,
    users_now,
)
from ..workspace import scratch_path
from .registry import query
from .reporting import _COUNT_SQL
from .roles import JSON_FILES, catalog, raw_files, with_roles

_ARTIST_ROWS = (
    "(SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude"
    " FROM catalog)"
)
_FIRST_PLAYS = (
    "(SELECT ts, userId FROM activity a SEMI JOIN catalog c ON c.title = a.song"
    " AND c.artist_name = a.artist AND c.duration = a.length WHERE page = 'NextSong')"
)
_USERS_LATEST = (
    "(SELECT a.userId FROM activity a JOIN (SELECT userId, max(ts) AS latest FROM activity"
    " WHERE {where} GROUP BY userId) m ON m.userId = a.userId AND m.latest = a.ts WHERE {where})"
)


def _report_sql(**rows: tuple[str, str]) -> str:
    return with_roles("activity catalog plays", " UNION ALL ".join(
        _COUNT_SQL.format(name=name, key=key, rows=source) for name, (key, source) in rows.items()
    ))


def _star_report(tables: dict[str, DataFrame]) -> DataFrame:
    return quality.load_report({t.name: (tables[t.name], list(t.key)) for t in STAR})


def _load(spark: SparkSession, sf_dir: str, preset: str) -> DataFrame:
    return _star_report(loads.load_star(
        spark,
        raw_files(spark, sf_dir, "catalog"),
        raw_files(spark, sf_dir, "activity"),
        scratch_path(spark, f"star-{preset}"),
        preset,
        pattern=JSON_FILES,
    ))


@query(_report_sql(
    users=("userId", "(SELECT DISTINCT userId FROM activity WHERE page = 'NextSong')"),
    artist=("artist_id", "(SELECT DISTINCT artist_id FROM catalog)"),
    song=("song_id", "catalog"),
    time=("ts", "(SELECT ts FROM activity WHERE page = 'NextSong')"),
    songplay=("n", f"(SELECT row_number() OVER () AS n FROM {_FIRST_PLAYS})"),
))
def load_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "keyed")


@query(_report_sql(
    users=("userId", _USERS_LATEST.format(where="true")),
    artist=("artist_id", _ARTIST_ROWS),
    song=("song_id", "catalog"),
    time=("start_time", "(SELECT DISTINCT start_time FROM plays)"),
    songplay=("n", "(SELECT row_number() OVER () AS n FROM (SELECT DISTINCT start_time, user_id,"
                   " level, song_id, artist_id, session_id, location, user_agent FROM plays))"),
))
def load_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "warehouse")


@query(_report_sql(
    users=("userId", _USERS_LATEST.format(where="page = 'NextSong'")),
    artist=("artist_id", _ARTIST_ROWS),
    song=("song_id", "catalog"),
    time=("ts", "(SELECT ts FROM activity WHERE page = 'NextSong')"),
    songplay=("n", "(SELECT row_number() OVER () AS n FROM plays)"),
))
def load_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "lake")


@query(_report_sql(
    session_library=("n", "(SELECT row_number() OVER () AS n FROM (SELECT DISTINCT sessionId,"
                          " itemInSession FROM activity WHERE page = 'NextSong'))"),
    user_activity=("n", "(SELECT row_number() OVER () AS n FROM (SELECT DISTINCT userId,"
                        " sessionId, itemInSession FROM activity WHERE page = 'NextSong'))"),
    song_library=("n", "(SELECT row_number() OVER () AS n FROM (SELECT DISTINCT song, userId"
                       " FROM activity WHERE page = 'NextSong'))"),
))
def load_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_files(spark, sf_dir, "event_csv")
    tables = loads.load_lookup_tables(spark, raw, scratch_path(spark, "lookups"))
    return quality.load_report({t.name: (tables[t.name], list(t.key)) for t in KEYED})


FILES_PER_BATCH = 2
BUCKETS = 16


@query(with_roles("activity", """
SELECT sessionId, itemInSession, ts, page, song, artist, CAST(userId AS BIGINT) AS userId FROM activity
"""))
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files loaded batch by batch into one dataset; the sum is the same as in one read."""
    source, out = raw_files(spark, sf_dir, "activity"), scratch_path(spark, "appended")
    each_new_file(
        spark,
        source,
        LOG_FILE,
        scratch_path(spark, "progress"),
        lambda rows, batch: append_batch(refuse_faults(log_faults(rows)), out, batch),
        files_per_batch=FILES_PER_BATCH,
        spread=True,
    )
    return read_batches(spark, out, STAGING_EVENTS).select(
        "sessionId", "itemInSession", "ts", "page", "song", "artist", "userId"
    )


@query(with_roles("activity", f"""
, played AS (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts, sessionId, itemInSession) AS n
  FROM activity WHERE page = 'NextSong')
SELECT CAST(userId AS BIGINT) AS user_id, arg_min(firstName, n) AS first_name,
       arg_min(lastName, n) AS last_name, arg_min(gender, n) AS gender,
       arg_max(level, n) AS level
FROM played GROUP BY userId
"""))
def incremental_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users merged batch by batch."""
    source, out = raw_files(spark, sf_dir, "activity"), scratch_path(spark, "user-states")
    each_new_file(
        spark,
        source,
        LOG_FILE,
        scratch_path(spark, "progress"),
        lambda rows, batch: merge_users_batch(plays(refuse_faults(log_faults(rows))), out, batch, BUCKETS),
        files_per_batch=FILES_PER_BATCH,
        spread=True,
    )
    return users_now(spark, out)


@query(_report_sql(
    users=("userId", "(SELECT DISTINCT userId FROM activity WHERE page = 'NextSong')"),
    time=("ts", "(SELECT ts FROM activity WHERE page = 'NextSong')"),
    songplay=("n", f"(SELECT row_number() OVER () AS n FROM {_FIRST_PLAYS})"),
))
def incremental_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, time and fact written batch by batch, song play ids counted on."""
    source = raw_files(spark, sf_dir, "activity")
    tables = load_activity_files(
        spark,
        source,
        catalog(spark, sf_dir),
        scratch_path(spark, "star-incremental"),
        scratch_path(spark, "progress"),
        files_per_batch=FILES_PER_BATCH,
        pattern=JSON_FILES,
        buckets=BUCKETS,
        spread=True,
    )
    return quality.load_report({
        t.name: (tables[t.name], list(t.key)) for t in STAR if t.name in tables
    })
