import csv
import gzip
import json

import pytest
from pyspark.sql import types as T

from playlake import sources
from playlake.operators import split_corrupt
from playlake.plans import keyed
from playlake.schemas import ARTIST, LOG_FILE, SESSION_LIBRARY, SONG, SONG_FILE, STAR, USERS
from tests import data
from tests.data import rows


def write_lines(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def test_json_is_found_at_any_depth_and_other_files_are_not(spark, tmp_path):
    write_lines(tmp_path / "a.json", {"ts": 1, "userId": "7"})
    write_lines(tmp_path / "2018" / "11" / "b.json", {"ts": 2, "registration": 1.5e12})
    write_lines(tmp_path / "2018" / "notes.txt", {"ts": 3})
    df = sources.read_json(spark, str(tmp_path), LOG_FILE, pattern="*.json")
    assert df.columns == LOG_FILE.fieldNames()
    assert rows(df, "ts", "userId", "registration") == [(1, "7", None), (2, None, 1.5e12)]
    everything = sources.read_json(spark, str(tmp_path), LOG_FILE)
    assert everything.count() == 3
    level = sources.read_json(spark, str(tmp_path / "*" / "*"), LOG_FILE, pattern="*.json")
    assert rows(level, "ts") == [(2,)]


def test_json_field_names_are_case_sensitive(spark, tmp_path):
    write_lines(tmp_path / "a.json", {"userid": "7", "ts": 1})
    assert rows(sources.read_json(spark, str(tmp_path), LOG_FILE), "userId") == [(None,)]


def test_malformed_lines_are_set_aside(spark, tmp_path):
    write_lines(tmp_path / "a.json", {"ts": 1}, "{broken", {"ts": 2})
    parsed, broken = split_corrupt(
        sources.read_json(spark, str(tmp_path), LOG_FILE, keep_corrupt=True)
    )
    assert rows(parsed, "ts") == [(1,), (2,)]
    assert rows(broken) == [("{broken",)]


def test_mapped_json_reads_nested_paths(spark, tmp_path):
    write_lines(tmp_path / "a.json", {"user": {"id": 5, "name": {"full": "x"}}, "t": 9})
    df = sources.read_mapped_json(spark, str(tmp_path), {
        "user_id": ("$.user.id", T.LongType()),
        "name": ("$['user']['name']['full']", T.StringType()),
        "at": ("$.t", T.LongType()),
    })
    assert [tuple(r) for r in df.collect()] == [(5, "x", 9)]
    for bad in ("$.a[x]", "$.a[]", "$", "$.a..b"):
        with pytest.raises(ValueError):
            sources.read_mapped_json(spark, str(tmp_path), {"c": (bad, T.LongType())})
    with pytest.raises(ValueError, match="goes through"):
        sources.read_mapped_json(
            spark, str(tmp_path), {"a": ("$.t", T.LongType()), "b": ("$.t.x", T.LongType())}
        )


def test_staging_types_and_clips(spark, tmp_path):
    write_lines(tmp_path / "l.json", {"userId": "", "registration": 1.5e12, "location": "x" * 300},
                {"userId": "8"})
    write_lines(tmp_path / "songs" / "s.json", {"song_id": "S", "title": "t" * 300, "year": 1999})
    events = sources.stage_events(spark, str(tmp_path / "l.json"))
    assert rows(events, "userId", "registration") == [(None, 1500000000000), (8, None)]
    assert max(len(r[0] or "") for r in rows(events, "location")) == 300
    songs = sources.stage_songs(spark, str(tmp_path / "songs"))
    assert [(len(r.title), r.year) for r in songs.collect()] == [(256, 1999)]


def test_scan_report_counts_files_without_rows_too(spark, tmp_path):
    write_lines(tmp_path / "in" / "a b.json", {"ts": 1}, {"ts": 2})
    (tmp_path / "in" / "blank.json").write_text("\n")
    (tmp_path / "in" / "zero").write_text("")
    path = str(tmp_path / "in")
    report = sources.scan_report(spark, sources.read_json(spark, path, LOG_FILE), path)
    found = {r["file"].rsplit("/", 1)[1]: (r["bytes"] > 0, r["rows"]) for r in report.collect()}
    assert found == {"a%20b.json": (True, 2), "blank.json": (True, 0), "zero": (False, 0)}


def test_every_file_below_a_prefix_is_staged(spark, tmp_path):
    write_lines(tmp_path / "a.json", {"song_id": "S1"})
    write_lines(tmp_path / "deep" / "part-0001", {"song_id": "S2"})
    with gzip.open(tmp_path / "deep" / "c.json.gz", "wt") as f:
        f.write('{"song_id": "S3"}\n')
    assert rows(sources.stage_songs(spark, str(tmp_path)), "song_id") == [("S1",), ("S2",), ("S3",)]
    assert rows(sources.stage_songs(spark, str(tmp_path / "d*")), "song_id") == [("S2",), ("S3",)]
    assert rows(sources.stage_songs(spark, str(tmp_path), pattern="*.json"), "song_id") == [("S1",)]


EVENT = ["Elena", "Logged In", "Lily", "F", "4", "Koch", "269.5", "paid", "Chicago, IL", "PUT",
         "NextSong", "1", "338", "Song", "200", "1541106106796", "8"]


def event_csv(path, *changes):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf8") as f:
        out = csv.writer(f)
        out.writerow([f"h{i}" for i in range(17)])
        for change in changes:
            out.writerow([change.get(i, v) for i, v in enumerate(EVENT)])


def test_event_csv_to_consolidated_csv_and_back(spark, tmp_path):
    event_csv(tmp_path / "in" / "a.csv", {0: 'A, ""B""'}, {0: ""})
    event_csv(tmp_path / "in" / "deep" / "b.csv", {0: " blank", 13: "", 8: "São Paulo"})
    raw = sources.read_event_csv(spark, str(tmp_path / "in"))
    assert raw.count() == 3
    out = str(tmp_path / "out")
    sources.write_consolidated(keyed.consolidate_events(raw), out)
    back = sources.read_consolidated(spark, out)
    assert rows(back, "artist", "song", "location", "sessionId") == [
        (" blank", None, "São Paulo", "338"), ('A, ""B""', "Song", "Chicago, IL", "338")
    ]
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    assert '"artist","firstName","gender"' in text
    assert all(line.startswith('"') and line.endswith('"') for line in text.splitlines())


def test_csv_fields_over_several_lines(spark, tmp_path):
    event_csv(tmp_path / "a.csv", {13: "two\nlines"}, {})
    df = sources.read_event_csv(spark, str(tmp_path), multiline=True)
    assert rows(df, "song", "userId") == [("Song", "8"), ("two\nlines", "8")]


def test_partition_values_keep_their_type_and_null(spark, tmp_path):
    songs = data.songs(
        spark,
        {"song_id": "1", "artist_id": "007"},
        {"song_id": "2", "artist_id": "7"},
        {"song_id": "3", "artist_id": "7", "year": None},
    ).select(SONG.columns)
    path = str(tmp_path / "song")
    sources.write_parquet(songs, path, partition_by=["year", "artist_id"])
    assert (tmp_path / "song" / "year=2004" / "artist_id=007").is_dir()
    back = sources.read_parquet(spark, path, SONG.schema).select(SONG.columns)
    assert rows(back) == rows(songs)


def test_overwriting_all_or_only_the_given_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    sources.write_parquet(df, path, partition_by=["p"])
    new = spark.createDataFrame([(3, "b")], "n int, p string")
    sources.write_parquet(new, path, partition_by=["p"], dynamic=True)
    assert rows(sources.read_parquet(spark, path, df.schema)) == [(1, "a"), (3, "b")]
    sources.write_parquet(new, path, partition_by=["p"])
    assert rows(sources.read_parquet(spark, path, df.schema)) == [(3, "b")]


def test_a_large_partition_is_written_by_many_tasks(spark, tmp_path, settings):
    settings({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"})
    df = spark.range(200_000).selectExpr("id", "uuid() AS u", "if(id % 10 < 9, 1, id % 10) AS p")
    sources.write_parquet(df.repartition(8), str(tmp_path / "t"), partition_by=["p"])
    assert len(list((tmp_path / "t" / "p=1").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_keyed_tables_are_sorted_and_split_by_their_whole_key(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 1, id) AS session_id", "id AS item_in_session", "'a' AS artist",
        "'s' AS song_title", "cast(1 AS float) AS song_length",
    )
    path = str(tmp_path / "t")
    sources.write_keyed(df, SESSION_LIBRARY, path, files=6)
    files = sorted((tmp_path / "t").glob("*.parquet"))
    assert len(files) == 6
    previous, holding = None, 0
    for file in files:
        keys = [tuple(r) for r in spark.read.parquet(str(file)).select(*SESSION_LIBRARY.key).collect()]
        assert keys == sorted(keys)
        assert previous is None or previous < keys[0]
        previous = keys[-1]
        holding += any(k[0] == 1 for k in keys)
    assert holding > 1


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE lifecycle LOCATION '{tmp_path}/db'")
    sources.create_tables(spark, STAR, "lifecycle")
    sources.create_tables(spark, STAR, "lifecycle")
    assert {t.name for t in spark.catalog.listTables("lifecycle")} == {t.name for t in STAR}
    user = spark.createDataFrame([("free", 1, "a", "b", "F")],
                                 "level string, user_id bigint, first_name string,"
                                 " last_name string, gender string")
    sources.insert_into(user, USERS, "lifecycle")
    sources.insert_into(user, USERS, "lifecycle")
    assert rows(spark.table("lifecycle.users")) == [(1, "a", "b", "F", "free")] * 2
    assert spark.table("lifecycle.artist").schema == ARTIST.schema
    sources.reset_tables(spark, [USERS], "lifecycle")
    assert spark.table("lifecycle.users").count() == 0
    sources.drop_tables(spark, STAR, "lifecycle")
    sources.drop_tables(spark, STAR, "lifecycle")
    assert spark.catalog.listTables("lifecycle") == []
    spark.sql("DROP DATABASE lifecycle")


def test_versions(spark, tmp_path):
    base = str(tmp_path / "users")
    assert sources.current_version(spark, base) is None
    row = "1 AS user_id, 'a' AS first_name, 'b' AS last_name, 'F' AS gender, '{}' AS level"
    for version, level in ((0, "free"), (3, "paid"), (3, "trial"), (10, "last")):
        sources.write_version(spark.sql("SELECT " + row.format(level)), base, version)
    (tmp_path / "users" / "version=000000000011").mkdir()
    assert sources.current_version(spark, base) == 10
    assert sources.current_version(spark, base, before=10) == 3
    assert rows(sources.read_version(spark, base, USERS, 3), "level") == [("trial",)]
    sources.expire_versions(spark, base, keep=2)
    assert sources.current_version(spark, base, before=3) is None
    assert sources.current_version(spark, base, before=10) == 3


def test_song_file_layout(spark, tmp_path):
    write_lines(tmp_path / "s.json", {"song_id": "S", "artist_latitude": None, "duration": 1.25})
    assert rows(sources.read_json(spark, str(tmp_path), SONG_FILE), "song_id", "duration",
                "artist_latitude") == [("S", 1.25, None)]
