"""Plays in time: levels as they were, sessions by gap, windows of a stream, sketches, sums over groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import reports, star
from ..schemas import LOG_FILE
from ..streaming import load_windowed_counts
from ..workspace import scratch_path
from .registry import query
from .roles import activity, event_log, with_roles

_DAY = 86_400_000
_DAYS = "CAST(make_timestamp((ts // 86400000) * 86400000000) AS TIMESTAMP)"


@query(with_roles("event_log", """
, levels AS (SELECT userId, ts, max(level) AS level FROM event_log WHERE page <> 'NextSong' AND userId <> '' GROUP BY userId, ts)
SELECT p.event_id, p.userId AS user, l.level
FROM (SELECT * FROM event_log WHERE page = 'NextSong' AND userId <> '') p
ASOF LEFT JOIN levels l ON p.userId = l.userId AND p.ts >= l.ts
"""))
def level_at_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level of each play's user at that time, as the latest line of another page tells."""
    log = event_log(spark, sf_dir).filter("userId <> ''").select("event_id", "userId", "ts", "page", "level")
    found = star.level_at_plays(log, log.filter("page <> 'NextSong'"))
    return found.select("event_id", F.col("userId").alias("user"), "level")


@query(with_roles("event_log", """
, marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY userId ORDER BY ts, event_id) <= 21600000 THEN 0 ELSE 1 END AS opens
  FROM event_log WHERE userId <> ''),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY userId ORDER BY ts, event_id) AS island FROM marked)
SELECT CAST(userId AS BIGINT) AS user_id, make_timestamp(min(ts) * 1000) AS first_moment, make_timestamp(max(ts) * 1000) AS last_moment,
       count(*) AS lines, CAST(count(*) FILTER (page = 'NextSong') AS BIGINT) AS plays
FROM numbered GROUP BY userId, island
"""))
def sessions_by_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions computed from the times of lines, closed by six hours without one."""
    return star.sessions_by_gap(event_log(spark, sf_dir), "6 hours")


@query(with_roles("event_log", f"""
, counted AS (
  SELECT {_DAYS} AS window_start, level, ts FROM event_log
  WHERE page = 'NextSong' AND NOT (event_id % 50 = 7 AND ts < 1704672000000))
SELECT window_start, level, count(*) AS plays FROM counted
WHERE window_start + INTERVAL 1 DAY <= (SELECT make_timestamp(max(ts) * 1000) - INTERVAL 2 DAY FROM counted)
GROUP BY window_start, level
"""))
def windowed_play_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per day from a stream of three files: some lines come too late, some come twice."""
    source = scratch_path(spark, "stream")
    log = event_log(spark, sf_dir).select(
        "event_id", "ts", "userId", "page", "level", F.col("event_id").alias("sessionId"), F.lit(0).cast("bigint").alias("itemInSession"))
    late = F.expr("event_id % 50 = 7 AND ts < 1704672000000")
    cuts = [0, 1704844800000, 1705708800000, 1 << 62]  # January 10 and 20
    for number in range(3):
        part = log.filter((F.col("ts") >= cuts[number]) & (F.col("ts") < cuts[number + 1]) & ~late)
        if number:  # the day before once more
            part = part.unionByName(log.filter((F.col("ts") >= cuts[number] - _DAY) & (F.col("ts") < cuts[number]) & ~late))
        if number == 2:
            part = part.unionByName(log.filter(late))
        part.select(*(c for c in LOG_FILE.fieldNames() if c in part.columns)).repartition(1).write.json(f"{source}/{number}")
    return load_windowed_counts(spark, source, scratch_path(spark, "windows"), scratch_path(spark, "progress"), files_per_batch=1)


@query(with_roles("activity", """
SELECT CAST(year(month) AS INT) AS year, CAST(month(month) AS INT) AS month, level, users, true AS within_bound FROM (
  SELECT date_trunc('month', make_timestamp(ts * 1000)) AS month, level, count(DISTINCT userId) AS users
  FROM activity WHERE page = 'NextSong' GROUP BY ALL)
"""))
def users_of_months_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per month and level from merged sketches of days, within 4 standard errors of the exact number."""
    log = activity(spark, sf_dir, "ts", "level", "userId", plays_only=True)
    fact = log.select(star.event_time("ts").alias("start_time"), "level", F.col("userId").cast("bigint").alias("user_id"))
    about = reports.users_of_months(reports.daily_user_sketches(fact)).withColumnRenamed("users", "about")
    exact = fact.groupBy(F.year("start_time").alias("year"), F.month("start_time").alias("month"), "level").agg(
        F.count_distinct("user_id").alias("users"))
    within = F.abs(F.col("about") - F.col("users")) <= F.lit(4 * reports.SKETCH_ERROR) * F.col("users")
    return exact.join(about, ["year", "month", "level"]).select("year", "month", "level", "users", within.alias("within_bound"))


@query(with_roles("activity", """
SELECT location AS country, level, CAST(date_trunc('month', make_timestamp(ts * 1000)) AS DATE) AS month,
       CAST(GROUPING(location, level, CAST(date_trunc('month', make_timestamp(ts * 1000)) AS DATE)) AS INT) AS grouping,
       count(*) AS plays, round(quantile_cont(length, 0.5), 4) AS median_length
FROM activity WHERE page = 'NextSong'
GROUP BY ROLLUP (location, level, CAST(date_trunc('month', make_timestamp(ts * 1000)) AS DATE))
HAVING count(*) >= 5
"""))
def play_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and median lengths by country, level and month with their sums, from 5 plays on."""
    log = activity(spark, sf_dir, "ts", "level", "location", "length", "page", plays_only=True)
    found = reports.play_rollup(log, least=5)
    return found.withColumn("median_length", F.round("median_length", 4))
