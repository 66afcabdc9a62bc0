"""Tables kept up over time: faulty lines, compaction, layouts, staging and keyed tables, changes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sources
from ..operators import dense_key, plays, table_changes
from ..plans import keyed, quality, star
from ..schemas import ARTIST, KEYED, LOG_FILE, SONG, STAGED_EVENTS, STAGING_EVENTS, STAGING_SONGS, TIME, USERS
from ..sources import log_faults, refuse_faults, typed_events
from ..streaming import append_batch, compact, each_new_file, load_activity_files, quarantined, read_batches
from ..workspace import scratch_path
from .lookups import _SESSION_SQL, _SONG_SQL, _USER_SQL
from .registry import query
from .roles import ARRIVAL, activity, catalog, event_log, raw_files, table, with_roles


@query(with_roles("activity catalog", """
, numbered AS (SELECT *, (sessionId * 7 + itemInSession) % 50 AS k FROM activity)
SELECT 'songplay' AS kind, sessionId AS session_id, count(*) AS n
FROM numbered a SEMI JOIN catalog c ON c.title = a.song AND c.artist_name = a.artist AND c.duration = a.length
WHERE page = 'NextSong' AND k NOT IN (3, 5) GROUP BY sessionId
UNION ALL SELECT 'malformed line', NULL, count(*) FROM numbered WHERE k = 3
UNION ALL SELECT 'itemInSession must not be null', NULL, count(*) FROM numbered WHERE k = 5
"""))
def incremental_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines and lines without an item number, over several batches: the others are loaded."""
    source, out = scratch_path(spark, "raw-broken"), scratch_path(spark, "star-broken")
    rows = activity(spark, sf_dir, spread=True).withColumn("k", F.expr("(sessionId * 7 + itemInSession) % 50"))
    item = F.when(F.col("k") != 5, F.col("itemInSession")).alias("itemInSession")
    line = F.to_json(F.struct(*(item if c == "itemInSession" else F.col(c) for c in LOG_FILE.fieldNames())))
    cut = F.when(F.col("k") == 3, F.left(line, F.lit(50))).otherwise(line)
    rows.select(cut.alias("value")).write.text(source, compression="gzip")
    tables = load_activity_files(
        spark, source, catalog(spark, sf_dir), out, scratch_path(spark, "progress"),
        files_per_batch=2, pattern=None, bad="quarantine", buckets=16, spread=True,
    )
    loaded = tables["songplay"].groupBy(F.lit("songplay").alias("kind"), "session_id").agg(F.count("*").alias("n"))
    left_out = quarantined(spark, out).groupBy(F.col("fault").alias("kind")).agg(F.count("*").alias("n"))
    return loaded.unionByName(left_out, allowMissingColumns=True)


@query(with_roles("activity", """
SELECT sessionId, itemInSession, ts, page, song, artist, CAST(userId AS BIGINT) AS userId FROM activity
"""))
def incremental_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended, compacted and one of them replayed, more appended and compacted again."""
    out = scratch_path(spark, "compacted")

    def append(raw: DataFrame, batch: int) -> None:
        rows = refuse_faults(log_faults(raw))
        append_batch(rows, out, batch)
        if batch % 2 == 0:
            compact(spark, out, STAGING_EVENTS, batch, order=["ts"])
            append_batch(rows, out, batch)

    log, source = activity(spark, sf_dir, spread=True).select(LOG_FILE.fieldNames()), scratch_path(spark, "raw-compacted")
    # compressed files, enough of them for all cores in each of five batches or a few more
    rows, least = table(spark, sf_dir, "lineitem").count(), 5 * spark.sparkContext.defaultParallelism
    log.write.option("maxRecordsPerFile", max(1, -(-rows // least))).json(source, compression="gzip")
    files = len(spark.read.text(source).inputFiles())
    each_new_file(
        spark, source, LOG_FILE, scratch_path(spark, "progress"), append, files_per_batch=max(1, files // 5)
    )
    return read_batches(spark, out, STAGING_EVENTS).select(
        "sessionId", "itemInSession", "ts", "page", "song", "artist", "userId"
    )


@query(with_roles("activity", """
SELECT u.gender, a.level, count(*) AS plays, CAST(sum(a.itemInSession) AS BIGINT) AS items
FROM activity a JOIN (SELECT DISTINCT userId, gender FROM activity) u USING (userId)
WHERE page = 'NextSong' GROUP BY u.gender, a.level
"""))
def plays_by_gender_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and users from two catalog tables in the same buckets, joined without an exchange."""
    root, name = scratch_path(spark, "bucketed"), uuid.uuid4().hex
    log = activity(spark, sf_dir, "userId", "gender", "level", "itemInSession", "page")
    users = log.select("userId", "gender").distinct()
    played = plays(log).select("userId", "level", "itemInSession")
    tables = [
        sources.write_bucketed(rows, f"{kind}_{name}", f"{root}/{kind}", ["userId"], 8)
        for kind, rows in (("plays", played), ("users", users))
    ]
    joined = tables[0].join(tables[1], "userId").groupBy("gender", "level").agg(
        F.count("*").alias("plays"), F.sum("itemInSession").alias("items"))
    joined.schema  # resolved: the files stay when the names go
    for kind in ("plays", "users"):
        spark.sql(f"DROP TABLE `{kind}_{name}`")
    return joined


@query(with_roles("event_log", """
SELECT user_id, first_name, last_name, gender, level FROM (
  SELECT CAST(userId AS BIGINT) AS user_id, firstName AS first_name, lastName AS last_name, gender, level,
         row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS n
  FROM event_log WHERE userId <> '') WHERE n = 1
"""))
def users_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users in one folder for each id, as the lake can lay them out."""
    path = scratch_path(spark, "users")
    users = star.users_latest(event_log(spark, sf_dir), precision="ms", ties="one", tie_break=["event_id"])
    sources.write_parquet(users, path, partition_by=["user_id"])
    return sources.read_parquet(spark, path, USERS.schema).select(USERS.columns)


@query(with_roles("activity", _SESSION_SQL + _USER_SQL + _SONG_SQL + """
SELECT 'staging_events' AS table_name, count(*) AS n, count(*) AS ids, CAST(0 AS BIGINT) AS first_id, count(*) - 1 AS last_id,
       count(ts) AS filled FROM activity
UNION ALL SELECT 'staging_songs', count(*), NULL, NULL, NULL, count(p_name) FROM part
UNION ALL SELECT 'session_library', count(*), NULL, NULL, NULL, count(session_id) FROM session_library
UNION ALL SELECT 'user_activity', count(*), NULL, NULL, NULL, count(user_id) FROM user_activity
UNION ALL SELECT 'song_library', count(*), NULL, NULL, NULL, count(song_title) FROM song_library
"""))
def staging_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging tables, events with their identity, and the keyed tables: dropped, created, filled."""
    root = scratch_path(spark, "staging")
    database, tables = "playlake_" + root.rsplit("-", 1)[1], f"{root}/tables"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    layout = (STAGED_EVENTS, STAGING_SONGS, *KEYED)
    sources.reset_tables(spark, layout, database, tables)
    # the log is joined once: the keyed tables are built from the stored events, too
    extra = [c for c in ARRIVAL if c not in STAGING_EVENTS.columns]
    log = typed_events(activity(spark, sf_dir, *STAGING_EVENTS.columns, *extra), keep=extra)
    numbered = dense_key(log, "event_id", start=0)
    sources.insert_into(numbered, STAGED_EVENTS, database)
    sources.insert_into(catalog(spark, sf_dir), STAGING_SONGS, database)
    for table, build in zip(KEYED, (keyed.session_library, keyed.user_activity, keyed.song_library), strict=True):
        sources.insert_into(build(numbered, ARRIVAL), table, database)
    sources.drop_tables(spark, layout, database)
    spark.sql(f"DROP DATABASE {database}")
    counted = None
    for table, column in zip(layout, ("ts", "title", "session_id", "user_id", "song_title"), strict=True):
        rows = sources.read_parquet(spark, f"{tables}/{table.name}", table.schema)
        ids = ([F.count_distinct("event_id"), F.min("event_id"), F.max("event_id")] if table is STAGED_EVENTS
               else [F.lit(None).cast("bigint")] * 3)
        one = rows.agg(F.count("*").alias("n"), F.count(column).alias("filled"),
                       *(i.alias(name) for i, name in zip(ids, ("ids", "first_id", "last_id"), strict=True)))
        one = one.select(F.lit(table.name).alias("table_name"), "n", "ids", "first_id", "last_id", "filled")
        counted = one if counted is None else counted.unionByName(one)
    return counted


def _columns_sql(table: str, source: str, **columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({i} AS INT) AS place, '{name}' AS column_name, '{kind}' AS type,"
        f" true AS as_declared, count({name}) AS filled FROM {source}"
        for i, (name, kind) in enumerate(columns.items(), 1)
    )


@query(with_roles("event_log", """, songs AS (
  SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_id, p_size AS year, p_retailprice AS duration FROM part),
artists AS (
  SELECT DISTINCT p_brand AS artist_id, p_brand AS name, p_type AS location, length(p_type) AS latitude, length(p_brand) AS longitude FROM part),
times AS (SELECT DISTINCT ts // 1000 AS start_time, 1 AS hour, 1 AS day, 1 AS week, 1 AS month, 1 AS year, 1 AS weekday FROM event_log)
""" + " UNION ALL ".join([
    _columns_sql("song", "songs", song_id="string", title="string", artist_id="string", year="int", duration="double"),
    _columns_sql("artist", "artists", artist_id="string", name="string", location="string", latitude="double", longitude="double"),
    _columns_sql("time", "times", start_time="timestamp_ntz", hour="int", day="int", week="int", month="int", year="int", weekday="int"),
])))
def column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of written tables as their files have them, next to the declared ones."""
    songs = catalog(spark, sf_dir)
    tables = {
        SONG: star.songs(songs),
        ARTIST: star.artists(songs),
        TIME: star.time_dimension(star.log_times(event_log(spark, sf_dir))),
    }
    out = scratch_path(spark, "columns")
    reports = []
    for table, rows in tables.items():
        sources.write_parquet(rows, f"{out}/{table.name}")
        reports.append(quality.column_report(spark.read.parquet(f"{out}/{table.name}"), table))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query(with_roles("event_log", """
, old AS (SELECT userId, level, count(*) AS n FROM event_log WHERE ts < 1705363200000 GROUP BY ALL),
new AS (SELECT userId, level, count(*) AS n FROM event_log WHERE ts >= 1705276800000 GROUP BY ALL),
both_ways AS (
  SELECT coalesce(o.userId, w.userId) AS userId, coalesce(o.level, w.level) AS level, coalesce(w.n, 0) - coalesce(o.n, 0) AS n
  FROM old o FULL JOIN new w ON o.userId = w.userId AND o.level = w.level)
SELECT CASE WHEN userId IN (SELECT userId FROM old) AND userId IN (SELECT userId FROM new)
            THEN CASE WHEN n > 0 THEN 'update_to' ELSE 'update_from' END
            WHEN n > 0 THEN 'insert' ELSE 'delete' END AS change, userId, level, abs(n) AS n
FROM both_ways WHERE n <> 0
"""))
def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two bags of users' levels, from the lines of overlapping times."""
    log = event_log(spark, sf_dir).select("ts", "userId", "level")
    old, new = log.filter("ts < 1705363200000").drop("ts"), log.filter("ts >= 1705276800000").drop("ts")
    return table_changes(old, new, ["userId"])


@query(with_roles("event_log", """
SELECT event_id AS id, userId AS first_user, page AS second_page, ts AS deep FROM event_log
"""))
def scan_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at positions of nested arrays, mapped to columns by path."""
    path = scratch_path(spark, "arrays")
    event_log(spark, sf_dir).select(
        "event_id",
        F.array(F.struct(F.col("userId").alias("name")), F.struct(F.col("page").alias("name"))).alias("who"),
        F.array(F.array(F.lit(0).cast("bigint")), F.array(F.lit(1).cast("bigint"), F.col("ts"))).alias("grid"),
    ).write.json(path)
    return sources.read_mapped_json(spark, path, {
        "id": ("$.event_id", T.LongType()),
        "first_user": ("$.who[0].name", T.StringType()),
        "second_page": ("$['who'][1]['name']", T.StringType()),
        "deep": ("$.grid[1][1]", T.LongType()),
    })
