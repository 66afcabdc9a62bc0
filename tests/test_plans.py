from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playlake.plans import keyed, quality, reports, star
from playlake.schemas import (
    ARTIST,
    SESSION,
    SESSION_LIBRARY,
    SONG,
    SONG_LIBRARY,
    SONGPLAY,
    TIME,
    USER_ACTIVITY,
    USERS,
)
from tests import data
from tests.data import rows


def test_songs_and_artists(spark):
    catalog = data.songs(spark, {}, {}, {"song_id": "S2", "artist_name": "ELENA"},
                         {"song_id": "S0", "artist_id": "A2", "artist_latitude": 35.5,
                          "artist_longitude": None})
    assert star.songs(catalog).count() == 3
    assert star.songs(catalog, dedupe=False).count() == 4
    assert rows(star.artists(catalog), "artist_id", "name") == [
        ("A1", "ELENA"), ("A1", "Elena"), ("A2", "Elena")
    ]
    assert rows(star.artists(catalog, one_per_id=True), "artist_id", "name") == [
        ("A1", "Elena"), ("A2", "Elena")
    ]
    whole = star.artist_columns(catalog, whole_coordinates=True).filter("artist_id = 'A2'")
    assert rows(whole, "latitude", "longitude") == [(36, None)]
    for df, table in ((star.songs(catalog), SONG), (star.artists(catalog), ARTIST)):
        assert quality.schema_differences(df, table) == []


def test_latest_users_compare_by_second_or_millisecond(spark):
    log = data.log(
        spark,
        {"ts": 1000, "level": "free"},
        {"ts": 2001, "level": "free"},
        {"ts": 2002, "level": "paid", "page": "Home"},
        {"userId": "", "ts": 9999},
        {"userId": None, "ts": 9999},
    )
    assert rows(star.users_latest(log), "user_id", "level") == [(8, "free"), (8, "paid")]
    assert rows(star.users_latest(log, ties="one"), "user_id", "level") == [(8, "paid")]
    assert rows(star.users_latest(log, precision="ms"), "user_id", "level") == [(8, "paid")]
    assert quality.schema_differences(star.users_latest(log), USERS) == []


def test_merged_users_keep_first_names_and_last_level(spark):
    log = data.log(
        spark,
        {"ts": 1, "level": "free", "firstName": "Lily"},
        {"ts": 2, "level": "paid", "firstName": "Lilian"},
        {"ts": 3, "level": "free", "lastName": "Smith"},
        {"userId": ""},
        {"userId": "x"},
    )
    assert rows(star.users_upsert(log)) == [(8, "Lily", "Koch", "F", "free")]
    assert quality.schema_differences(star.users_upsert(log), USERS) == []


def test_time_dimension(spark, zone):
    log = data.log(spark, {"ts": 1541106106796}, {"ts": 1541106106999}, {"ts": 1541106107000})
    ms = star.time_dimension(star.log_times(log, precision="ms"), distinct=False, style="mon0")
    assert [r[0] for r in rows(ms)] == [
        datetime(2018, 11, 1, 21, 1, 46, 796000),
        datetime(2018, 11, 1, 21, 1, 46, 999000),
        datetime(2018, 11, 1, 21, 1, 47),
    ]
    assert rows(star.time_dimension(star.log_times(log))) == [
        (datetime(2018, 11, 1, 21, 1, 46), 21, 1, 44, 11, 2018, 4),
        (datetime(2018, 11, 1, 21, 1, 47), 21, 1, 44, 11, 2018, 4),
    ]
    assert quality.schema_differences(ms, TIME) == []


def test_songplays(spark):
    log = data.log(
        spark,
        {"ts": 1541106106796},
        {"ts": 1541106106799},
        {"page": "Home"},
        {"song": None},
        {"userId": "", "ts": 1541106200000},
    )
    catalog = data.songs(spark, {}, {"song_id": "S2"})
    assert star.songplays(log, catalog).count() == 6
    assert star.songplays(log, catalog, match="first").count() == 3
    assert star.songplays(log, catalog, dedupe=True).count() == 4
    assert star.songplays(log, catalog, match="first", dedupe=True, precision="ms").count() == 3
    fact = star.keyed_songplays(star.songplays(log, catalog, match="first"), "dense")
    assert quality.schema_differences(fact, SONGPLAY) == []
    assert rows(fact, "songplay_id") == [(1,), (2,), (3,)]
    assert rows(fact.filter("user_id = 8"), "start_time", "song_id", "session_id")[0] == (
        datetime(2018, 11, 1, 21, 1, 46), "S1", 1
    )
    months = star.with_year_month(fact)
    assert rows(months.select("year", "month").distinct()) == [(2018, 11)]


def test_sessions(spark):
    log = data.log(spark, {}, {"itemInSession": 1}, {"sessionId": 2, "userId": ""})
    assert rows(star.sessions(log), "session_id", "user_id") == [(1, 8), (2, None)]
    assert quality.schema_differences(star.sessions(log), SESSION) == []


def events(spark, *changes):
    return data.log(spark, *changes).withColumn("seq", F.monotonically_increasing_id())


def test_the_last_row_of_a_key_wins_in_lookup_tables(spark):
    log = data.log(
        spark,
        {"sessionId": 338, "itemInSession": 4, "song": "old", "ts": 1},
        {"sessionId": 338, "itemInSession": 4, "song": "new", "ts": 2},
        {"sessionId": 338, "itemInSession": 2, "song": "second", "ts": 3},
        {"sessionId": None, "itemInSession": 2, "ts": 4},
        {"sessionId": 338, "itemInSession": 9, "userId": "", "song": "old", "ts": 5},
    )
    with pytest.raises(Exception, match="session_id must not be null"):
        keyed.session_library(log, ["ts"]).collect()
    sessions = keyed.session_library(log, ["ts"], incomplete="drop")
    assert rows(keyed.session_item(sessions, 338, 4), "artist", "song_title") == [("Elena", "new")]
    assert sessions.count() == 3
    activity = keyed.user_activity(log, ["ts"], incomplete="drop")
    found = [r.song_title for r in keyed.session_songs(activity, 8, 338).collect()]
    assert found == ["second", "new"]
    library = keyed.song_library(log, ["ts"], incomplete="drop")
    assert rows(keyed.listeners(library, "old")) == [("Lily Koch",)]
    for df, table in (
        (sessions, SESSION_LIBRARY), (activity, USER_ACTIVITY), (library, SONG_LIBRARY)
    ):
        assert quality.schema_differences(df, table) == []


def test_lookup_tables_from_text_rows(spark):
    text = data.log(spark, {"length": 1.5}).select(
        *(F.col(c).cast("string").alias(c) for c in
          ("artist", "song", "length", "sessionId", "itemInSession", "userId", "ts"))
    )
    assert rows(keyed.session_library(text, ["ts"])) == [(1, 0, "Elena", "Setanta matins", 1.5)]


def test_a_lookup_names_its_partition_key(spark):
    library = keyed.song_library(data.log(spark, {}), ["ts"])
    with pytest.raises(ValueError):
        keyed.lookup(library, SONG_LIBRARY, ["user"], user_id=8)
    with pytest.raises(ValueError):
        keyed.lookup(library, SONG_LIBRARY, ["user"], song_title="x", user="y")


def fact(spark):
    played = [
        ("a1", "s1", "FR", 1, "paid", "2018-11-01 00:00:00"),
        ("a1", "s1", "FR", 1, "paid", "2018-11-30 23:59:59"),
        ("a2", "s2", "FR", 2, "free", "2018-11-05 00:00:00"),
        ("a2", "s3", "DE", 3, "paid", "2018-12-01 00:00:00"),
        ("a3", "s4", "DE", 4, "paid", "2018-12-31 10:00:00"),
        ("a9", "s9", "DE", None, "paid", "2018-12-31 10:00:00"),
    ]
    return spark.createDataFrame(
        played, "artist_id string, song_id string, location string, user_id bigint, level string,"
                " start_time string"
    ).withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


def test_top_reports(spark):
    artists = spark.createDataFrame(
        [("a1", "Beck"), ("a1", "BECK"), ("a2", "Muse"), ("a3", "Air")],
        "artist_id string, name string",
    )
    songs = spark.createDataFrame(
        [(f"s{i}", f"title {i}") for i in range(1, 5)], "song_id string, title string"
    )
    top = reports.top_artists(fact(spark), artists, 2)
    assert [tuple(r) for r in top.collect()] == [("a1", "BECK", 2), ("a2", "Muse", 2)]
    top = reports.top_songs(fact(spark), songs, 3)
    assert [tuple(r) for r in top.collect()] == [
        ("s1", "title 1", 2), ("s2", "title 2", 1), ("s3", "title 3", 1)
    ]
    assert rows(reports.top_artists_by_country(fact(spark), artists, k=1)) == [
        ("DE", 1, "a2", "Muse", 1), ("FR", 1, "a1", "BECK", 2)
    ]
    assert rows(reports.top_songs_by_country(fact(spark), songs, k=2), "location", "pos", "song_id") == [
        ("DE", 1, "s3"), ("DE", 2, "s4"), ("FR", 1, "s1"), ("FR", 2, "s2")
    ]


def test_counting_before_the_join_gives_the_counts_of_the_fact(spark):
    log = data.log(spark, {}, {}, {"song": "b"}, {"song": "absent"}, {"page": "Home"})
    catalog = data.songs(spark, {}, {"song_id": "S2"}, {"song_id": "S3", "title": "b"})
    counts = reports.play_counts(log, catalog, ["location"])
    whole = star.songplays(log, catalog)
    dim = star.songs(catalog)
    assert reports.top_songs(counts, dim).collect() == reports.top_songs(whole, dim).collect()
    assert rows(reports.top_songs_by_country(counts, dim)) == rows(
        reports.top_songs_by_country(whole, dim)
    )


@pytest.mark.parametrize(("year", "month", "users"), [(2018, 11, 1), (2018, 12, 2), (2018, 10, 0)])
def test_paid_users_of_a_month(spark, zone, year, month, users):
    assert reports.paid_users(fact(spark), year, month).first()[0] == users


def test_songs_of_an_artist(spark):
    catalog = data.songs(spark, {}, {"song_id": "S2", "title": "b"}, {"song_id": "S3", "artist_id": "A2"})
    joined = reports.songs_of_artists(star.songs(catalog), star.artists(catalog, one_per_id=True))
    assert rows(joined.filter("artist_id = 'A1'"), "song_id") == [("S1",), ("S2",)]


def test_load_report_and_orphans(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, name string")
    empty = df.limit(0)
    report = quality.load_report({"t": (df, ["id"]), "e": (empty, ["id", "name"])})
    assert rows(report) == [("e", 0, 0, 0), ("t", 3, 1, 1)]
    dim = spark.createDataFrame([("a1",), ("a1",), ("a3",)], "artist_id string")
    assert rows(quality.orphans(fact(spark), dim, "artist_id")) == [("a2", 2), ("a9", 1)]
    assert rows(quality.orphan_report(fact(spark), {"artist_id": dim})) == [("artist_id", 3)]


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, "a")], "user_id int, nickname string")
    assert quality.schema_differences(df, USERS) == [
        "missing first_name", "missing last_name", "missing gender", "missing level",
        "unexpected nickname", "user_id is int, not bigint",
    ]


def test_preview_is_ordered(spark):
    assert [r.id for r in reports.preview(spark.range(100).repartition(7), ["id"]).collect()] == [
        0, 1, 2, 3, 4
    ]


def test_a_blank_name_leaves_its_part_of_the_user_blank(spark):
    log = data.log(spark, {"lastName": None}, {"firstName": None, "userId": "9"})
    assert rows(keyed.user_activity(log, ["ts"]), "user") == [(" Koch",), ("Lily ",)]


def test_the_first_match_goes_by_the_stored_artist(spark):
    catalog = data.songs(
        spark,
        {"song_id": "S1", "artist_id": "A1", "artist_name": "Elena", "title": "one", "duration": 1.5},
        {"song_id": "S2", "artist_id": "A1", "artist_name": "Elena feat. X", "title": "two", "duration": 1.5},
    )
    log = data.log(
        spark,
        {"song": "two", "artist": "Elena", "length": 1.5},
        {"song": "two", "artist": "Elena feat. X", "length": 1.5, "userId": "9"},
    )
    assert rows(star.songplays(log, catalog, match="first"), "user_id", "song_id") == [(8, "S2")]
