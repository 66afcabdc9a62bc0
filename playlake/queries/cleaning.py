"""Projections, filters, casts and time expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    event_date,
    event_time,
    nan_to_null,
    round_to_int,
    to_float,
    to_id,
    weekday,
)
from ..operators import known_users, plays, split_valid
from ..plans import star
from .registry import query
from .roles import catalog, event_log, table, with_roles


@query(with_roles("catalog", """
SELECT artist_id, artist_name AS name, artist_location AS location,
       artist_latitude AS latitude, artist_longitude AS longitude
FROM catalog
"""))
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.artist_columns(catalog(spark, sf_dir))


@query(with_roles("catalog", """
SELECT artist_id, artist_name AS name, artist_location AS location,
       CAST(round(artist_latitude) AS INTEGER) AS latitude,
       CAST(round(artist_longitude) AS INTEGER) AS longitude
FROM catalog
"""))
def project_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.artist_columns(catalog(spark, sf_dir), whole_coordinates=True)


@query(with_roles("event_log", "SELECT * FROM event_log WHERE page = 'NextSong'"))
def filter_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays(event_log(spark, sf_dir))


@query(with_roles("event_log", """
SELECT event_id, TRY_CAST(userId AS BIGINT) AS user_id, level FROM event_log WHERE userId <> ''
"""))
def filter_known_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_users(event_log(spark, sf_dir)).select(
        "event_id", to_id("userId").alias("user_id"), "level"
    )


@query(with_roles("event_log", """
SELECT event_id, TRY_CAST(userId AS BIGINT) AS user_id, TRY_CAST(page AS BIGINT) AS page_number,
       CAST(value AS FLOAT) AS value_float, CAST(round(event_id / 4.0) AS INTEGER) AS quarter
FROM event_log WHERE NOT isnan(value)
"""))
def numeric_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_log(spark, sf_dir)
    return rows.filter(~F.isnan("value")).select(
        "event_id",
        to_id("userId").alias("user_id"),
        to_id("page").alias("page_number"),
        to_float("value").alias("value_float"),
        round_to_int(F.col("event_id") / 4.0).alias("quarter"),
    )


@query(with_roles("event_log", """
SELECT event_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM event_log
"""))
def nan_to_null_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("event_id", nan_to_null("value").alias("value"))


_TYPED_SQL = """typed AS (
  SELECT event_id, TRY_CAST(userId AS BIGINT) AS user_id,
         CASE WHEN isnan(value) THEN NULL ELSE value END AS value
  FROM event_log)"""


@query(with_roles("event_log", f"""
, {_TYPED_SQL}
SELECT event_id, user_id, value, user_id IS NOT NULL AND value IS NOT NULL AS valid FROM typed
"""))
def not_null_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected rows of one load, each marked with its side."""
    typed = event_log(spark, sf_dir).select(
        "event_id", to_id("userId").alias("user_id"), nan_to_null("value").alias("value")
    )
    valid, rejected = split_valid(typed, ["user_id", "value"])
    return valid.withColumn("valid", F.lit(True)).unionByName(
        rejected.withColumn("valid", F.lit(False))
    )


@query(with_roles(
    "event_log", "SELECT event_id, make_timestamp(ts * 1000) AS start_time FROM event_log"
))
def event_time_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("event_id", event_time("ts", "ms").alias("start_time"))


@query(with_roles("event_log", """
SELECT event_id, make_timestamp((ts // 1000) * 1000000) AS start_time FROM event_log
"""))
def event_time_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("event_id", event_time("ts", "s").alias("start_time"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("event_id", event_date("ts").alias("day"))


_PARTS_SQL = """
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, CAST({weekday} AS INTEGER) AS weekday
FROM ({moments})
"""


@query(with_roles("event_log", _PARTS_SQL.format(
    weekday="isodow(start_time) - 1",
    moments="SELECT make_timestamp(ts * 1000) AS start_time FROM event_log WHERE page = 'NextSong'",
)))
def time_dim_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time row per play, milliseconds kept."""
    times = star.log_times(plays(event_log(spark, sf_dir)), precision="ms")
    return star.time_dimension(times, distinct=False, style="mon0")


@query(_PARTS_SQL.format(
    weekday="dayofweek(start_time)", moments="SELECT DISTINCT l_shipdate AS start_time FROM lineitem"
))
def time_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time row per moment."""
    return star.time_dimension(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("""
SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS mon0, CAST(dayofweek(ts) AS INTEGER) AS sun0,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS sun1
FROM events
""")
def weekday_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", *(weekday("ts", style).alias(style) for style in ("mon0", "sun0", "sun1"))
    )
