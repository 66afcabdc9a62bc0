"""Play reports over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import event_time
from ..operators import first_per_key, plays, resolve_all, top_k, top_k_per_group
from ..operators.resolve import MATCH

# Fixed value: the level of a paying user.
PAID = "paid"


def play_counts(log: DataFrame, catalog: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Songs with their number of ``plays``, per value of the log columns ``by``.

    To be reported on like a fact, without resolving every play: plays are counted by
    title, artist and length before the catalog is joined. The join then sees each song
    once, however often it was played, and the log is shuffled only as counts.
    """
    counts = plays(log).groupBy(*(a for a, _ in MATCH), *by).agg(F.count("*").alias("plays"))
    return resolve_all(counts, catalog)


def _named(
    best: DataFrame, dim: DataFrame, group: Sequence[str], key: str, label: str
) -> DataFrame:
    """``best`` with one ``label`` per row: the smallest, where the dimension has several.

    A label that many rows of the dimension repeat is combined per task, before labels are ranked.
    """
    hits = dim.select(key, label).join(best, key).distinct()
    return first_per_key(hits, [*group, key], [label])


def _top(fact: DataFrame, dim: DataFrame, key: str, label: str, k: int) -> DataFrame:
    best = top_k(fact, [key], k)
    return (
        _named(best, dim, [], key, label)
        .select(key, label, "plays")
        .orderBy(F.desc("plays"), key)
        .limit(k)
    )


def top_artists(fact: DataFrame, artists: DataFrame, k: int = 5) -> DataFrame:
    """The most played artists with their names, one row per artist id."""
    return _top(fact, artists, "artist_id", "name", k)


def top_songs(fact: DataFrame, songs: DataFrame, k: int = 5) -> DataFrame:
    """The most played songs with their titles."""
    return _top(fact, songs, "song_id", "title", k)


def _top_by(
    fact: DataFrame, dim: DataFrame, group: Sequence[str], key: str, label: str, k: int
) -> DataFrame:
    best = top_k_per_group(fact, group, [key], k)
    return _named(best, dim, group, key, label).select(*group, "pos", key, label, "plays")


def top_artists_by_country(
    fact: DataFrame, artists: DataFrame, country: str = "location", k: int = 5
) -> DataFrame:
    """The most played artists of every country."""
    return _top_by(fact, artists, [country], "artist_id", "name", k)


def top_songs_by_country(
    fact: DataFrame, songs: DataFrame, country: str = "location", k: int = 5
) -> DataFrame:
    """The most played songs of every country."""
    return _top_by(fact, songs, [country], "song_id", "title", k)


def paid_users(fact: DataFrame, year: int, month: int) -> DataFrame:
    """How many different paid users played something in a month.

    The month is a range of ``start_time``, which a Parquet scan can prune by.
    """
    begin = f"{year:04d}-{month:02d}-01"
    end = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return fact.filter(
        (F.col("level") == PAID)
        & (F.col("start_time") >= F.lit(begin).cast("timestamp_ntz"))
        & (F.col("start_time") < F.lit(end).cast("timestamp_ntz"))
    ).agg(F.countDistinct("user_id").alias("number_of_paid_users"))


def songs_of_artists(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Every song with the name of its artist; filter by ``name`` for one artist's songs."""
    return songs.join(artists.select("artist_id", "name"), "artist_id").select(
        "artist_id", "name", "song_id", "title", "year", "duration"
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a given order."""
    return df.orderBy(*order).limit(n)


# Base-2 logarithm of a sketch's registers. Its relative standard error is 1.04 / sqrt(4096).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / (1 << SKETCH_BITS) ** 0.5


def daily_user_sketches(fact: DataFrame) -> DataFrame:
    """Per day and level a HyperLogLog sketch of the users who played something.

    A sketch has a fixed size however many users it has seen, and sketches of days merge to those
    of months, which counts of days don't: a user of two days is one user of the month. So a day is
    read once, when it is over.
    """
    return fact.groupBy(F.to_date("start_time").alias("day"), "level").agg(
        F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("users")
    )


def users_of_months(sketches: DataFrame) -> DataFrame:
    """Per month and level about how many different users played something, from the days' sketches."""
    return sketches.groupBy(F.year("day").alias("year"), F.month("day").alias("month"), "level").agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users")
    )


def play_rollup(log: DataFrame, country: str = "location", least: int = 1) -> DataFrame:
    """Plays and the median length by country, level and month, and summed up over month, level and
    country; only groups of ``least`` plays or more. ``grouping`` tells sums from values: a bit for each
    column that is summed over, country first.

    Equal lengths are counted before the rows are multiplied for the sums, and the exact median is
    taken from those counts.
    """
    rows = plays(log).select(
        F.col(country).alias("country"), "level", F.date_trunc("month", event_time("ts")).cast("date").alias("month"), "length")
    counted = rows.groupBy("country", "level", "month", "length").agg(F.count("*").alias("n"))
    return (
        counted.rollup("country", "level", "month")
        .agg(
            F.grouping_id().cast("int").alias("grouping"),
            F.sum("n").alias("plays"),
            F.percentile("length", 0.5, F.col("n")).alias("median_length"),
        )
        .filter(F.col("plays") >= least)
    )
