"""Dimensions, upserts, the fact and its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import event_time, to_id
from ..operators import (
    dense_key,
    distinct_rows,
    hash_key,
    insert_absent,
    known_users,
    latest_per_key,
    plays,
    read_numbered,
    resolve_all,
    sparse_key,
    write_numbered,
)
from ..plans import reports, star
from ..schemas import ARTIST
from ..sources import read_parquet, write_parquet
from ..workspace import scratch_path
from .registry import query
from .roles import FACT_SQL, activity, catalog, event_log, table, with_roles

# The log columns a songplay is made of.
PLAY_COLUMNS = (
    "artist", "song", "length", "page", "ts", "userId", "level", "sessionId", "location",
    "userAgent",
)

_ARTIST_SQL = """artist_id, artist_name AS name, artist_location AS location,
       artist_latitude AS latitude, artist_longitude AS longitude"""


@query(with_roles("catalog", "SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalog"))
def songs_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.songs(catalog(spark, sf_dir))


@query(with_roles("catalog", f"SELECT DISTINCT {_ARTIST_SQL} FROM catalog"))
def artists_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.artists(catalog(spark, sf_dir))


@query("SELECT DISTINCT o_custkey AS user_id, o_orderpriority AS level FROM orders")
def users_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(
        table(spark, sf_dir, "orders"),
        [F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("level")],
    )


@query(with_roles("catalog", f"""
SELECT {_ARTIST_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS n FROM catalog)
WHERE n = 1
"""))
def artists_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.artists(catalog(spark, sf_dir), one_per_id=True)


@query(with_roles("catalog", """
, firsts AS (
  SELECT title AS artist_id, artist_name AS name, artist_location AS location,
         artist_latitude AS latitude, artist_longitude AS longitude, year > 5 AS late,
         row_number() OVER (PARTITION BY title, year > 5 ORDER BY song_id) AS n
  FROM catalog)
SELECT artist_id, name, location, latitude, longitude FROM firsts f
WHERE n = 1 AND (NOT late OR NOT EXISTS (
  SELECT 1 FROM firsts e WHERE e.artist_id = f.artist_id AND NOT e.late))
"""))
def artists_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second adding only the ids that the first did not store."""
    path = scratch_path(spark, "artist")
    rows = catalog(spark, sf_dir).withColumn("artist_id", F.col("title"))
    first, second = rows.filter("year <= 5"), rows.filter("year > 5")
    write_parquet(star.artist_columns(insert_absent(None, first, ARTIST.key, ["song_id"])), path)
    existing = read_parquet(spark, path, ARTIST.schema)
    fresh = insert_absent(existing, second, ARTIST.key, ["song_id"])
    write_parquet(star.artist_columns(fresh), path, mode="append")
    return read_parquet(spark, path, ARTIST.schema)


@query(with_roles("event_log", """
SELECT CAST(userId AS BIGINT) AS user_id, arg_min(firstName, event_id) AS first_name,
       arg_min(lastName, event_id) AS last_name, arg_min(gender, event_id) AS gender,
       arg_max(level, event_id) AS level
FROM event_log WHERE userId <> '' GROUP BY userId
"""))
def users_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.users_upsert(event_log(spark, sf_dir), ["event_id"])


@query("""
SELECT o.o_custkey AS user_id, o.o_orderkey AS order_key, o.o_orderpriority AS level
FROM orders o
JOIN (SELECT o_custkey, max(o_orderdate) AS latest FROM orders GROUP BY o_custkey) m
  ON m.o_custkey = o.o_custkey AND m.latest = o.o_orderdate
""")
def users_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderpriority").alias("level"),
    )


@query("""
SELECT user_id, order_key, level FROM (
  SELECT o_custkey AS user_id, o_orderkey AS order_key, o_orderpriority AS level,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders)
WHERE n = 1
""")
def users_latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        "o_orderdate",
        ties="one",
        tie_break=["o_orderkey"],
    ).select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderpriority").alias("level"),
    )


def _latest_sql(moment: str, where: str) -> str:
    return with_roles("activity", f"""
SELECT CAST(a.userId AS BIGINT) AS user_id, a.firstName AS first_name, a.lastName AS last_name,
       a.gender, a.level
FROM activity a
JOIN (SELECT userId, max({moment}) AS latest FROM activity WHERE userId <> '' {where}
      GROUP BY userId) m ON m.userId = a.userId AND m.latest = {moment.replace("ts", "a.ts")}
WHERE true {where}
""")


_USER_COLUMNS = (
    "userId", "firstName", "lastName", "gender", "level", "page", "ts", "sessionId",
    "itemInSession",
)


@query(_latest_sql("ts // 1000", ""))
def users_latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as of their latest log line on any page, compared by second."""
    return star.users_latest(activity(spark, sf_dir, *_USER_COLUMNS))


@query(_latest_sql("ts", "AND page = 'NextSong'"))
def users_latest_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as of their latest play, compared by millisecond."""
    return star.users_latest(plays(activity(spark, sf_dir, *_USER_COLUMNS, plays_only=True)), precision="ms")


@query(with_roles("event_log", """
SELECT CAST(userId AS BIGINT) AS user_id, max(ts) AS max_ts FROM event_log
WHERE userId <> '' GROUP BY userId
"""))
def max_ts_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        known_users(event_log(spark, sf_dir))
        .groupBy(to_id("userId").alias("user_id"))
        .agg(F.max("ts").alias("max_ts"))
    )


@query(with_roles("catalog", f"""
SELECT s.artist_id, a.name, s.song_id, s.title, s.year, s.duration
FROM (SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalog) s
JOIN (SELECT DISTINCT {_ARTIST_SQL} FROM catalog) a ON a.artist_id = s.artist_id
"""))
def song_artist_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs with their artists; an artist of several spellings repeats its songs."""
    rows = catalog(spark, sf_dir)
    return reports.songs_of_artists(star.songs(rows), star.artists(rows))


@query(with_roles("catalog", """
SELECT DISTINCT artist_id, artist_name AS name, song_id, title, year, duration
FROM catalog WHERE artist_name = 'Brand#7'
"""))
def songs_by_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All songs released by one artist."""
    rows = catalog(spark, sf_dir)
    joined = reports.songs_of_artists(star.songs(rows), star.artists(rows, one_per_id=True))
    return joined.filter(F.col("name") == "Brand#7")


def fact(spark: SparkSession, sf_dir: str, **rules) -> DataFrame:
    log = activity(spark, sf_dir, *PLAY_COLUMNS, plays_only=True)
    return star.songplays(log, catalog(spark, sf_dir), **rules)


@query(with_roles("activity catalog plays", f"SELECT {FACT_SQL} FROM plays"))
def songplays_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


@query(with_roles("activity catalog plays", f"""
SELECT DISTINCT {FACT_SQL} FROM (
  SELECT * FROM plays UNION ALL SELECT * FROM plays WHERE item_in_session = 1)
"""))
def songplays_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first items of every session come twice, as from a file loaded again."""
    log = activity(spark, sf_dir, *PLAY_COLUMNS, "itemInSession", plays_only=True)
    replayed = log.unionByName(log.filter("itemInSession = 1"))
    return star.songplays(replayed, catalog(spark, sf_dir), dedupe=True)


@query(with_roles("activity catalog", """
, one AS (
  SELECT title, artist_name, duration, min(song_id) AS song_id, arg_min(artist_id, song_id) AS artist_id
  FROM catalog GROUP BY ALL)
SELECT make_timestamp(ts * 1000) AS start_time, CAST(userId AS BIGINT) AS user_id, level,
       song_id, artist_id, sessionId AS session_id, location, userAgent AS user_agent
FROM activity a JOIN one c ON c.title = a.song AND c.artist_name = a.artist AND c.duration = a.length
WHERE page = 'NextSong'
"""))
def songplays_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, match="first", precision="ms")


@query(with_roles("activity catalog plays", f"SELECT {FACT_SQL} FROM plays"))
def songplays_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths compared as decimals of five places."""
    return fact(spark, sf_dir, scale=5)


@query(with_roles("activity catalog plays", f"""
SELECT row_number() OVER (ORDER BY start_time, session_id, item_in_session, song_id, supp_key)
         AS songplay_id,
       {FACT_SQL}, item_in_session, supp_key
FROM plays
"""))
def songplays_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive ids in time order."""
    log = activity(spark, sf_dir, *PLAY_COLUMNS, "itemInSession", "suppKey", plays_only=True)
    rows = resolve_all(plays(log), catalog(spark, sf_dir)).select(
        event_time("ts").alias("start_time"),
        to_id("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        F.col("itemInSession").alias("item_in_session"),
        F.col("suppKey").alias("supp_key"),
    )
    order = ["start_time", "session_id", "item_in_session", "song_id", "supp_key"]
    return dense_key(rows, "songplay_id", order)


_IDS_SQL = with_roles("activity catalog plays", f"""
SELECT CAST(count(*) AS BIGINT) AS ids, CAST({{low}} AS BIGINT) AS low,
       CAST({{high}} AS BIGINT) AS high FROM plays
""")


@query(_IDS_SQL.format(low="0", high="count(*) - 1"))
def songplay_serial_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive ids from 0 in the order the rows happen to have, without a shuffle."""
    return star.keyed_songplays(fact(spark, sf_dir), "dense", start=0).agg(
        F.countDistinct("songplay_id").alias("ids"),
        F.min("songplay_id").alias("low"),
        F.max("songplay_id").alias("high"),
    )


@query(_IDS_SQL.format(low="1", high="count(*)"))
def songplay_numbered_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive ids from 1 of a fact that was written once, added as it is read."""
    path, rows = scratch_path(spark, "numbered"), fact(spark, sf_dir)
    write_numbered(rows, path)
    return read_numbered(spark, path, "songplay_id", rows.schema).agg(
        F.countDistinct("songplay_id").alias("ids"),
        F.min("songplay_id").alias("low"),
        F.max("songplay_id").alias("high"),
    )


@query(with_roles("activity catalog plays", """
SELECT CAST(count(*) AS BIGINT) AS sparse_ids, CAST(count(*) AS BIGINT) AS hash_ids FROM plays
"""))
def songplay_sparse_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different ids the two unstored modes give: one per row."""
    rows = fact(spark, sf_dir, dedupe=True)
    keyed = sparse_key(hash_key(rows, "by_hash", rows.columns), "sparse")
    return keyed.agg(
        F.countDistinct("sparse").alias("sparse_ids"), F.countDistinct("by_hash").alias("hash_ids")
    )


@query(with_roles("activity", """
SELECT DISTINCT sessionId AS session_id, CAST(userId AS BIGINT) AS user_id, location,
       userAgent AS user_agent
FROM activity
"""))
def session_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sessions(activity(spark, sf_dir, "sessionId", "userId", "location", "userAgent"))
