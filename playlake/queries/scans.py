"""File scans and sinks: what is written is read back whole."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sources
from ..functions import clip_text
from ..operators import append_unique
from ..plans import keyed, star
from ..schemas import (
    ARTIST,
    LOG_FILE,
    SONG,
    SONG_FILE,
    STAR,
    TIME,
    USERS,
)
from ..workspace import at_once, scratch_path
from .registry import query
from .roles import (
    LOG_COLUMNS_SQL,
    activity,
    catalog,
    event_log,
    raw_files,
    table,
    with_roles,
)

_LOG_SQL = with_roles("activity", f"SELECT {LOG_COLUMNS_SQL} FROM activity")


@query(with_roles("catalog", "SELECT * FROM catalog"))
def scan_song_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_json(spark, raw_files(spark, sf_dir, "catalog"), SONG_FILE)


@query(_LOG_SQL)
def scan_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_json(spark, raw_files(spark, sf_dir, "activity"), LOG_FILE)


@query(with_roles("event_log", "SELECT event_id, ts, userId, page FROM event_log"))
def scan_json_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files at two folder levels, next to CSV files that must be passed over."""
    root = scratch_path(spark, "tree")
    rows = event_log(spark, sf_dir).select("event_id", "ts", "userId", "page")
    for side, keep in (("left", F.col("page") == "NextSong"), ("right", F.col("page") != "NextSong")):
        part = rows.filter(keep)
        part.withColumn("kind", F.col("page")).write.partitionBy("kind").json(f"{root}/{side}")
        part.write.csv(f"{root}/{side}/csv")
    schema = T.StructType([
        T.StructField("event_id", T.LongType()),
        *(LOG_FILE[c] for c in ("ts", "userId", "page")),
    ])
    return sources.read_json(spark, root, schema, pattern="*.json")


@query(with_roles(
    "event_log", "SELECT event_id AS id, userId AS user_name, page AS action, ts FROM event_log"
))
def scan_json_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys mapped to columns by path, nested ones included."""
    path = scratch_path(spark, "mapped")
    event_log(spark, sf_dir).select(
        "event_id",
        F.struct(
            F.col("ts").alias("at"),
            F.struct(F.col("userId").alias("name")).alias("user"),
        ).alias("meta"),
        F.col("page").alias("what"),
    ).write.json(path)
    return sources.read_mapped_json(spark, path, {
        "id": ("$.event_id", T.LongType()),
        "user_name": ("$.meta.user.name", T.StringType()),
        "action": ("$['what']", T.StringType()),
        "ts": ("$.meta.at", T.LongType()),
    })


@query("""
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(3 AS BIGINT) AS files,
       CAST(1 AS BIGINT) AS empty_files FROM lineitem
""")
def scan_files_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with rows, and one without any.

    The two files are compressed: as plain text they are many times all else that the query writes. One task
    writes a file, and one reads it. All tasks make its lines, in a compressed table with a half for each file, so
    that the one task only has to pack them.
    """
    path, halves = scratch_path(spark, "report"), scratch_path(spark, "report-halves")
    log = activity(spark, sf_dir, spread=True).select(F.to_json(F.struct(*LOG_FILE.fieldNames())).alias("value"))
    # Runs of 64 neighbours, as they are alike; a task's first two rows come apart, so two rows make two files.
    run = F.shiftright(F.monotonically_increasing_id() + 63, 6)
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")  # a task keeps both open, and sorts nothing
    writer = log.withColumn("half", run % 2).write.partitionBy("half").option("parquet.enable.dictionary", "false")
    writer.parquet(halves, compression="zstd")
    line = T.StructType([T.StructField("value", T.StringType())])

    def write(half: int) -> None:
        lines = sources.read_parquet(spark, f"{halves}/half={half}", line).coalesce(1)
        # the lowest level, at a third more bytes: the time of the one task counts
        lines.write.option("zlib.compress.level", "BEST_SPEED").text(f"{path}/log/{half}", compression="gzip")

    at_once(partial(write, 0), partial(write, 1))
    spark.range(1).select(F.lit("").alias("value")).coalesce(1).write.text(f"{path}/blank")
    rows = sources.read_json(spark, path, LOG_FILE)
    return sources.scan_report(spark, rows, path).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("files"),
        F.count_if(F.col("rows") == 0).alias("empty_files"),
    )


@query(with_roles("activity", """
SELECT artist, auth, firstName, gender, itemInSession, lastName, length, level, location, method,
       page, CAST(registration AS BIGINT) AS registration, sessionId, song, status, ts, userAgent,
       CAST(userId AS BIGINT) AS userId
FROM activity
"""))
def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.stage_events(spark, raw_files(spark, sf_dir, "activity"))


@query(with_roles("catalog", "SELECT * FROM catalog"))
def stage_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.stage_songs(spark, raw_files(spark, sf_dir, "catalog"))


@query("SELECT doc_id, left(text, 256) AS text FROM documents")
def staging_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clip_text("text").alias("text"))


@query(with_roles("activity", """
SELECT artist, firstName, gender, CAST(itemInSession AS VARCHAR) AS itemInSession, lastName,
       CAST(length AS VARCHAR) AS length, level, location, CAST(sessionId AS VARCHAR) AS sessionId,
       song, userId
FROM activity WHERE page = 'NextSong'
"""))
def csv_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event CSV to the consolidated CSV and back; rows without an artist are left out."""
    out = scratch_path(spark, "consolidated")
    raw = sources.read_event_csv(spark, raw_files(spark, sf_dir, "event_csv"))
    sources.write_consolidated(keyed.consolidate_events(raw), out)
    return sources.read_consolidated(spark, out)


@query(with_roles("event_log", """
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year,
       CAST(dayofweek(start_time) AS INTEGER) AS weekday
FROM (SELECT DISTINCT make_timestamp((ts // 1000) * 1000000) AS start_time FROM event_log)
"""))
def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "time")
    times = star.time_dimension(star.log_times(event_log(spark, sf_dir)))
    sources.write_parquet(times, path, partition_by=["year", "month"])
    return sources.read_parquet(spark, path, TIME.schema).select(TIME.columns)


@query(with_roles("catalog", "SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalog"))
def songs_by_year_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs in one folder for each year and artist, as the lake lays them out by id."""
    path = scratch_path(spark, "song")
    sources.write_parquet(star.songs(catalog(spark, sf_dir)), path, partition_by=["year", "artist_id"])
    return sources.read_parquet(spark, path, SONG.schema).select(SONG.columns)


@query(with_roles("catalog", """
SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
       artist_latitude AS latitude, artist_longitude AS longitude
FROM catalog
"""))
def parquet_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "artist")
    sources.write_parquet(star.artists(catalog(spark, sf_dir)), path)
    return sources.read_parquet(spark, path, ARTIST.schema)


@query(with_roles("catalog", """
SELECT song_id, title, artist_id, year, duration FROM catalog WHERE year <= 25
UNION ALL SELECT song_id, title, artist_id, year, duration FROM catalog WHERE year > 25
"""))
def songs_unique_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended to one dataset, each checked to bring no song id twice."""
    path = scratch_path(spark, "song")
    rows = star.songs(catalog(spark, sf_dir), dedupe=False)
    first, second = rows.filter("year <= 25"), rows.filter("year > 25")
    sources.write_parquet(append_unique(None, first, SONG.key), path, mode="append")
    existing = sources.read_parquet(spark, path, SONG.schema)
    sources.write_parquet(append_unique(existing, second, SONG.key), path, mode="append")
    return sources.read_parquet(spark, path, SONG.schema)


@query("""
SELECT o_custkey AS user_id, 'first' AS first_name, o_orderstatus AS last_name, 'F' AS gender,
       o_orderpriority AS level
FROM orders
UNION ALL
SELECT c_custkey, 'second', c_name, 'M', c_mktsegment FROM customer
""")
def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reset the catalog tables, insert from one query, append another, drop, read what stays."""
    root = scratch_path(spark, "catalog")
    database, tables = "playlake_" + root.rsplit("-", 1)[1], f"{root}/tables"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    sources.reset_tables(spark, STAR, database, tables)
    sources.insert_into(
        table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("user_id"),
            F.lit("first").alias("first_name"),
            F.col("o_orderstatus").alias("last_name"),
            F.lit("F").alias("gender"),
            F.col("o_orderpriority").alias("level"),
        ),
        USERS,
        database,
    )
    sources.insert_into(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("user_id"),
            F.lit("second").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.lit("M").alias("gender"),
            F.col("c_mktsegment").alias("level"),
        ),
        USERS,
        database,
    )
    sources.drop_tables(spark, STAR, database)
    spark.sql(f"DROP DATABASE {database}")
    return sources.read_parquet(spark, f"{tables}/{USERS.name}", USERS.schema)
