"""The driver's tables in the roles of song catalog and activity log.

``catalog``    one row per part, in the layout of the song files
``activity``   one row per line item, in the layout of the log files
``event_log``  one row per event, with sub-second times, blank users and NaN values

Each role is given as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_CSV_COLUMNS, LOG_FILE, SONG_FILE
from ..workspace import scratch_path

# Arrival order of activity rows; unique on the driver's tables.
ARRIVAL = ["ts", "sessionId", "itemInSession", "partKey", "suppKey"]
ARRIVAL_SQL_DESC = "ts DESC, sessionId DESC, itemInSession DESC, partKey DESC, suppKey DESC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        (F.length("p_type") + 0.5).cast("double").alias("artist_latitude"),
        (-0.25 - F.length("p_brand")).cast("double").alias("artist_longitude"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


CATALOG_SQL = """catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title, p_brand AS artist_id,
         p_brand AS artist_name, p_type AS artist_location,
         CAST(length(p_type) + 0.5 AS DOUBLE) AS artist_latitude,
         CAST(-0.25 - length(p_brand) AS DOUBLE) AS artist_longitude,
         p_retailprice AS duration, p_size AS year
  FROM part)"""


_FROM_LINEITEM = {
    "itemInSession": lambda: F.col("l_linenumber").cast("bigint"),
    "sessionId": lambda: F.col("l_orderkey"),
    "page": lambda: F.when(F.col("l_returnflag") == "R", "NextSong").otherwise("Home"),
    "ts": lambda: _epoch_ms("l_shipdate"),
    "auth": lambda: F.when(F.col("l_linestatus") == "O", "Logged In").otherwise("Logged Out"),
    "method": lambda: F.when(F.col("l_returnflag") == "R", "PUT").otherwise("GET"),
    "status": lambda: F.lit(200).cast("bigint"),
    "partKey": lambda: F.col("l_partkey"),
    "suppKey": lambda: F.col("l_suppkey"),
}
_FROM_PART = {
    "artist": lambda: F.col("p_brand"),
    "song": lambda: F.col("p_name"),
    "length": lambda: F.col("p_retailprice"),
}
_FROM_ORDERS = {
    "userId": lambda: F.col("o_custkey").cast("string"),
    "level": lambda: F.when(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "paid"
    ).otherwise("free"),
    "registration": lambda: _epoch_ms("o_orderdate").cast("double"),
}
_FROM_CUSTOMER = {
    "firstName": lambda: F.split_part("c_name", F.lit("#"), F.lit(1)),
    "lastName": lambda: F.split_part("c_name", F.lit("#"), F.lit(2)),
    "gender": lambda: F.when(F.col("c_acctbal") < 0, "F").otherwise("M"),
    "userAgent": lambda: F.col("c_mktsegment"),
}
_FROM_NATION = {"location": lambda: F.col("n_name")}
_COLUMNS = {**_FROM_LINEITEM, **_FROM_PART, **_FROM_ORDERS, **_FROM_CUSTOMER, **_FROM_NATION}


def activity(
    spark: SparkSession, sf_dir: str, *columns: str, plays_only: bool = False, spread: bool = False
) -> DataFrame:
    """The log columns asked for, all of ``LOG_FILE`` by default.

    Only the tables those columns come from are joined. The foreign keys are complete, so
    a join that adds no column would neither add nor drop rows. ``plays_only`` gives the
    lines of the play page, as a filter that the scan can use. ``spread`` deals the line items
    by their order before it is joined, so that few rows lie in several tasks, too; that is the
    shuffle that the join takes of many rows anyway, while they are still narrow.
    """
    columns = columns or tuple(LOG_FILE.fieldNames())
    wanted = set(columns)
    rows = table(spark, sf_dir, "lineitem")
    if plays_only:
        rows = rows.filter(F.col("l_returnflag") == "R")
    if wanted & _FROM_PART.keys():
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if wanted & {*_FROM_ORDERS, *_FROM_CUSTOMER, *_FROM_NATION}:
        # Orders are completed before they meet the far more numerous line items, which
        # then take one shuffle for all of it.
        buyers = table(spark, sf_dir, "orders")
        if wanted & {*_FROM_CUSTOMER, *_FROM_NATION}:
            customers = table(spark, sf_dir, "customer")
            if wanted & _FROM_NATION.keys():
                nations = table(spark, sf_dir, "nation")
                customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            buyers = buyers.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        if spread:
            rows = rows.repartition("l_orderkey")
        rows = rows.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select([_COLUMNS[c]().alias(c) for c in columns])


ACTIVITY_SQL = """activity AS (
  SELECT p_brand AS artist,
         CASE WHEN l_linestatus = 'O' THEN 'Logged In' ELSE 'Logged Out' END AS auth,
         split_part(c_name, '#', 1) AS firstName,
         CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(l_linenumber AS BIGINT) AS itemInSession,
         split_part(c_name, '#', 2) AS lastName,
         p_retailprice AS length,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'paid' ELSE 'free' END AS level,
         n_name AS location,
         CASE WHEN l_returnflag = 'R' THEN 'PUT' ELSE 'GET' END AS method,
         CASE WHEN l_returnflag = 'R' THEN 'NextSong' ELSE 'Home' END AS page,
         CAST(epoch_us(o_orderdate) // 1000 AS DOUBLE) AS registration,
         l_orderkey AS sessionId,
         p_name AS song,
         CAST(200 AS BIGINT) AS status,
         CAST(epoch_us(l_shipdate) // 1000 AS BIGINT) AS ts,
         c_mktsegment AS userAgent,
         CAST(o_custkey AS VARCHAR) AS userId,
         l_partkey AS partKey, l_suppkey AS suppKey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

LOG_COLUMNS_SQL = ", ".join(LOG_FILE.fieldNames())


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        _epoch_ms("ts").alias("ts"),
        F.when(kind == "error", "").otherwise(F.col("user_id").cast("string")).alias("userId"),
        F.when(kind == "view", "NextSong").otherwise(kind).alias("page"),
        kind.alias("firstName"),
        F.substring("props", 1, 6).alias("lastName"),
        F.when(F.col("value") < 5, "F").otherwise("M").alias("gender"),
        F.when(F.col("value") < 10, "free").otherwise("paid").alias("level"),
        F.when(kind == "signup", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )


EVENT_LOG_SQL = """event_log AS (
  SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts,
         CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS userId,
         CASE WHEN event_type = 'view' THEN 'NextSong' ELSE event_type END AS page,
         event_type AS firstName, substring(props, 1, 6) AS lastName,
         CASE WHEN value < 5 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN value < 10 THEN 'free' ELSE 'paid' END AS level,
         CASE WHEN event_type = 'signup' THEN CAST('nan' AS DOUBLE) ELSE value END AS value
  FROM events)"""


# The songplay fact over these roles: every matching song, and the columns that order it.
PLAYS_SQL = """plays AS (
  SELECT make_timestamp((ts // 1000) * 1000000) AS start_time,
         CAST(userId AS BIGINT) AS user_id, level, c.song_id, c.artist_id,
         sessionId AS session_id, location, userAgent AS user_agent,
         itemInSession AS item_in_session, suppKey AS supp_key
  FROM activity a
  JOIN catalog c ON c.title = a.song AND c.artist_name = a.artist AND c.duration = a.length
  WHERE page = 'NextSong')"""

FACT_SQL = (
    "start_time, user_id, level, song_id, artist_id, session_id, location, user_agent"
)

_CTES = {
    "catalog": CATALOG_SQL,
    "activity": ACTIVITY_SQL,
    "event_log": EVENT_LOG_SQL,
    "plays": PLAYS_SQL,
}


def with_roles(names: str, body: str) -> str:
    """``body`` behind the named common table expressions."""
    return "WITH " + ",\n".join(_CTES[n] for n in names.split()) + "\n" + body


#: Raw files that were written beforehand, by tables and role; see ``prepare``.
_PREPARED: dict[tuple[str, str], str] = {}


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write the raw files of all roles once, for all queries that follow: they only read them.
    To time queries without the making of their input."""
    for role in ("catalog", "activity", "event_csv"):
        _PREPARED.pop((sf_dir, role), None)
        _PREPARED[sf_dir, role] = raw_files(spark, sf_dir, role)


#: What the files of ``raw_files`` are named like.
JSON_FILES = "*.json.gz"


def raw_files(spark: SparkSession, sf_dir: str, role: str) -> str:
    """The ``catalog`` or ``activity`` role as JSON files, or as ``event_csv`` files that name
    the artist on plays only. The files are compressed: as text they are many times the tables."""
    if (sf_dir, role) in _PREPARED:
        return _PREPARED[sf_dir, role]
    path = scratch_path(spark, f"raw-{role}")
    if role == "catalog":
        catalog(spark, sf_dir).select(SONG_FILE.fieldNames()).write.json(path, compression="gzip")
    elif role == "activity":
        # The roles come out of joins in few tasks; spread, they become several files.
        rows = activity(spark, sf_dir, spread=True)
        rows.select(LOG_FILE.fieldNames()).write.json(path, compression="gzip")
    else:
        rows = activity(spark, sf_dir, *EVENT_CSV_COLUMNS, spread=True)
        artist = F.when(F.col("page") == "NextSong", F.col("artist"))
        rows.withColumn("artist", artist).write.option("header", True).option(
            "escape", '"'
        ).csv(path, compression="gzip")
    return path
