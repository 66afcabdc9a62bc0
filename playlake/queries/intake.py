"""Cases of raw input that the other queries' tables do not show: odd file names, broken lines,
incomplete rows, several spellings of an artist, blank names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import keyed, loads, star
from ..schemas import LOG_FILE, SONG_FILE
from ..sources import stage_songs
from ..workspace import scratch_path
from .registry import query
from .roles import activity, catalog, with_roles


@query(with_roles("catalog", """
SELECT 'prefix' AS how, song_id, title, year FROM catalog
UNION ALL
SELECT 'glob' AS how, song_id, title, year FROM catalog WHERE CAST(song_id AS BIGINT) % 3 <> 0
"""))
def stage_any_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs as ``.json``, as ``.json.gz`` and as ``.txt`` files, at three depths."""
    base = scratch_path(spark, "any-file")
    songs = catalog(spark, sf_dir).select(SONG_FILE.fieldNames())
    third = F.col("song_id").cast("long") % 3
    songs.filter(third == 0).write.json(f"{base}/plain")
    songs.filter(third == 1).write.option("compression", "gzip").json(f"{base}/deep/gzip")
    lines = songs.filter(third == 2).select(F.to_json(F.struct(*songs.columns)).alias("value"))
    lines.write.text(f"{base}/deep/er/lines")
    columns = ("song_id", "title", "year")
    return (stage_songs(spark, base).select(F.lit("prefix").alias("how"), *columns)
            .union(stage_songs(spark, f"{base}/d*").select(F.lit("glob"), *columns)))


@query(with_roles("activity", """
SELECT CASE WHEN itemInSession IN (2, 3) THEN 'quarantined' ELSE 'loaded' END AS kind,
       CASE itemInSession WHEN 2 THEN 'malformed line' WHEN 3 THEN 'itemInSession must not be null' END AS fault,
       CASE WHEN itemInSession NOT IN (2, 3) THEN sessionId END AS session_id,
       CASE WHEN itemInSession NOT IN (2, 3) THEN ts END AS ts
FROM activity
"""))
def stage_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second item's line broken off, every third one's number missing."""
    base, out = scratch_path(spark, "broken"), scratch_path(spark, "staged")
    log = activity(spark, sf_dir, spread=True).select(LOG_FILE.fieldNames())
    item = F.when(F.col("itemInSession") != 3, F.col("itemInSession")).alias("itemInSession")
    line = F.to_json(F.struct(*[item if c == "itemInSession" else c for c in log.columns]))
    broken = F.when(F.col("itemInSession") == 2, F.left(line, F.length(line) - 3)).otherwise(line)
    log.select(broken.alias("value")).write.text(f"{base}/log", compression="gzip")
    catalog(spark, sf_dir).select(SONG_FILE.fieldNames()).write.json(f"{base}/songs", compression="gzip")
    events, _ = loads.stage(spark, f"{base}/songs", f"{base}/log", out, bad="quarantine")
    aside = spark.read.parquet(f"{out}/quarantine/staging_events")
    nothing = F.lit(None)
    return events.select(F.lit("loaded").alias("kind"), nothing.cast("string").alias("fault"),
                         F.col("sessionId").alias("session_id"), "ts").union(
        aside.select(F.lit("quarantined"), "fault", nothing.cast("bigint"), nothing.cast("bigint")))


@query(with_roles("activity catalog", """
, spelled AS (
  SELECT *, CASE WHEN CAST(song_id AS BIGINT) % 2 = 0 THEN artist_name ELSE artist_name || ' feat. X' END AS spelling
  FROM catalog
), stored AS (
  SELECT artist_id, arg_min(spelling, song_id) AS name FROM spelled GROUP BY artist_id
), one AS (
  SELECT title, name, duration, min(song_id) AS song_id, arg_min(artist_id, song_id) AS artist_id
  FROM catalog JOIN stored USING (artist_id) GROUP BY ALL)
SELECT make_timestamp(ts * 1000) AS start_time, CAST(userId AS BIGINT) AS user_id, level,
       song_id, artist_id, sessionId AS session_id, location, userAgent AS user_agent
FROM activity a JOIN one c ON c.title = a.song AND c.name = a.artist AND c.duration = a.length
WHERE page = 'NextSong'
"""))
def songplays_stored_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second song spells its artist otherwise: plays are matched by the stored spelling."""
    plain = F.col("song_id").cast("long") % 2 == 0
    spelled = catalog(spark, sf_dir).withColumn(
        "artist_name", F.when(plain, F.col("artist_name")).otherwise(F.concat("artist_name", F.lit(" feat. X")))
    )
    return star.songplays(activity(spark, sf_dir), spelled, match="first", precision="ms")


@query(with_roles("activity", """
SELECT song AS song_title, CAST(userId AS BIGINT) AS user_id,
       CASE WHEN CAST(userId AS BIGINT) % 3 = 0 THEN '' ELSE arg_max(firstName, (ts, sessionId, itemInSession)) END || ' '
       || CASE WHEN CAST(userId AS BIGINT) % 2 = 0 THEN '' ELSE arg_max(lastName, (ts, sessionId, itemInSession)) END AS user
FROM activity WHERE page = 'NextSong' GROUP BY song, userId
"""))
def song_library_blank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listeners whose first or last name is blank, as a CSV scan reads it."""
    user = F.col("userId").cast("bigint")
    log = activity(spark, sf_dir, plays_only=True).withColumns({
        "firstName": F.when(user % 3 != 0, F.col("firstName")),
        "lastName": F.when(user % 2 != 0, F.col("lastName")),
    })
    return keyed.song_library(log, ["ts", "sessionId", "itemInSession"])
