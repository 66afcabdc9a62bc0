import json

import pytest

from playlake.plans import loads
from playlake.schemas import KEYED, STAR, STAGING_EVENTS
from playlake.sources import read_json, typed_events
from playlake.schemas import LOG_FILE
from playlake.streaming import (
    activity_tables,
    append_batch,
    each_new_file,
    load_activity_files,
    merge_users_batch,
    read_batches,
    users_now,
)
from playlake.plans import star
from tests import data
from tests.data import rows
from tests.test_sources import event_csv

LOGS = [
    {"ts": 1541106106796, "level": "free"},
    {"ts": 1541106106799, "level": "paid", "itemInSession": 1, "firstName": "Lilian"},
    {"ts": 1541106106799, "level": "paid", "itemInSession": 2, "song": "absent"},
    {"ts": 1541206106799, "level": "free", "itemInSession": 3, "page": "Home"},
    {"ts": 1544106106799, "userId": "9", "sessionId": 2, "level": "free"},
    {"ts": 1544106206799, "userId": "", "sessionId": 3, "page": "Login"},
]
SONGS = [{}, {"song_id": "S2", "artist_name": "Elena", "artist_location": "Abu Dhabi"},
         {"song_id": "S3", "title": "other", "artist_id": "A2", "year": 0}]


@pytest.fixture
def raw(spark, tmp_path):
    data.log(spark, *LOGS).repartition(3).write.json(str(tmp_path / "log"))
    data.songs(spark, *SONGS).write.json(str(tmp_path / "songs"))
    return str(tmp_path / "songs"), str(tmp_path / "log"), str(tmp_path / "out")


def sizes(tables):
    return {t.name: tables[t.name].count() for t in STAR}


def test_keyed_load(spark, raw):
    tables = loads.load_star(spark, *raw, "keyed")
    assert sizes(tables) == {"users": 2, "artist": 2, "song": 3, "time": 4, "songplay": 3}
    assert rows(tables["users"], "user_id", "first_name", "level") == [
        (8, "Lily", "paid"), (9, "Lily", "free")
    ]
    assert rows(tables["artist"], "artist_id", "location")[0] == ("A1", "Dubai UAE")
    assert rows(tables["songplay"], "songplay_id") == [(1,), (2,), (3,)]
    assert rows(tables["songplay"].select("song_id").distinct()) == [("S1",)]
    assert min(rows(tables["time"], "start_time"))[0].microsecond == 796000


def test_keyed_load_refuses_a_repeated_song(spark, raw, tmp_path):
    data.songs(spark, {}, {}).write.mode("overwrite").json(raw[0])
    with pytest.raises(ValueError, match="duplicate song_id"):
        loads.load_star(spark, *raw, "keyed")


def test_warehouse_load(spark, raw):
    tables = loads.load_star(spark, *raw, "warehouse")
    assert sizes(tables) == {"users": 2, "artist": 3, "song": 3, "time": 2, "songplay": 6}
    assert rows(tables["users"], "user_id", "level") == [(8, "free"), (9, "free")]
    assert rows(tables["songplay"], "songplay_id") == [(i,) for i in range(6)]
    assert rows(tables["time"], "weekday") == [(4,), (4,)]


@pytest.mark.parametrize("preset", ["keyed", "warehouse", "lake"])
def test_every_table_of_a_load_is_written_compressed_well(spark, raw, tmp_path, preset, monkeypatch):
    monkeypatch.setattr(loads, "delete_folder", lambda spark, path: None)  # keeps the scratch table
    loads.load_star(spark, *raw, preset)
    files = list((tmp_path / "out").rglob("*.parquet"))
    tables = {"staging_events", "staging_songs", *(t.name for t in STAR)} | ({"_scratch"} if preset != "lake" else set())
    assert {f.relative_to(tmp_path / "out").parts[0] for f in files if f.is_file()} == tables
    assert all(f.name.endswith(".zstd.parquet") for f in files)


def test_warehouse_load_enforces_required_columns(spark, raw):
    data.log(spark, {"location": None}).write.mode("overwrite").json(raw[1])
    with pytest.raises(Exception, match="location must not be null"):
        loads.load_star(spark, *raw, "warehouse")


def test_lake_load(spark, raw, tmp_path):
    tables = loads.load_star(spark, *raw, "lake", by_id=True)
    assert sizes(tables) == {"users": 3, "artist": 3, "song": 3, "time": 4, "songplay": 6}
    assert rows(tables["users"], "user_id", "level") == [(8, "paid"), (8, "paid"), (9, "free")]
    assert tables["songplay"].select("songplay_id").distinct().count() == 6
    out = tmp_path / "out"
    assert (out / "songplay" / "year=2018" / "month=12").is_dir()
    assert (out / "song" / "year=2004" / "artist_id=A1").is_dir()
    assert (out / "users" / "user_id=9").is_dir()
    assert rows(tables["song"], "song_id", "artist_id", "year") == [
        ("S1", "A1", 2004), ("S2", "A1", 2004), ("S3", "A2", 0)
    ]


@pytest.mark.parametrize("preset", list(loads.PRESETS))
def test_loading_again_gives_the_same_tables(spark, raw, preset):
    first = {n: rows(df.drop("songplay_id")) for n, df in loads.load_star(spark, *raw, preset).items()}
    again = {n: rows(df.drop("songplay_id")) for n, df in loads.load_star(spark, *raw, preset).items()}
    assert first == again
    songs = {r[0] for r in rows(loads.load_star(spark, *raw, preset)["song"], "song_id")}
    assert songs == {"S1", "S2", "S3"}


def test_a_load_leaves_nothing_but_its_tables(spark, raw, tmp_path):
    for preset in ("keyed", "warehouse"):
        out = tmp_path / preset
        loads.load_star(spark, *raw[:2], str(out), preset)
        names = {t.name for t in STAR} | {"staging_events", "staging_songs"}
        assert {p.name for p in out.iterdir()} == names


def test_lookup_tables_from_event_files(spark, tmp_path):
    event_csv(tmp_path / "in" / "a.csv", {13: "first"}, {13: "second"}, {0: ""})
    event_csv(tmp_path / "in" / "b.csv", {4: "2", 13: "third"}, {16: "9", 13: "second"})
    tables = loads.load_lookup_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert set(tables) == {t.name for t in KEYED}
    assert rows(tables["session_library"], "item_in_session", "song_title") == [
        (2, "third"), (4, "second")
    ]
    assert rows(tables["user_activity"], "user_id", "item_in_session", "song_title") == [
        (8, 2, "third"), (8, 4, "second"), (9, 4, "second")
    ]
    assert rows(tables["song_library"], "song_title", "user_id") == [
        ("first", 8), ("second", 8), ("second", 9), ("third", 8)
    ]


def add_file(path, name, *changes):
    path.mkdir(exist_ok=True)
    lines = [json.dumps(change) for change in changes]
    (path / name).write_text("\n".join(lines) + "\n")


def test_each_file_is_handed_over_once(spark, tmp_path):
    out, seen = str(tmp_path / "out"), []

    def handler(batch_rows, batch):
        seen.append(batch)
        append_batch(typed_events(batch_rows), out, batch)

    def run():
        each_new_file(spark, str(tmp_path / "in"), LOG_FILE, str(tmp_path / "progress"), handler,
                      files_per_batch=1)

    add_file(tmp_path / "in", "a.json", {"ts": 1}, {"ts": 2})
    add_file(tmp_path / "in", "b.json", {"ts": 3})
    run()
    run()
    assert rows(read_batches(spark, out, STAGING_EVENTS), "ts") == [(1,), (2,), (3,)]
    assert seen == [0, 1]
    add_file(tmp_path / "in", "c.json", {"ts": 4})
    run()
    assert rows(read_batches(spark, out, STAGING_EVENTS), "ts") == [(1,), (2,), (3,), (4,)]
    assert seen == [0, 1, 2]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    base, appended = str(tmp_path / "users"), str(tmp_path / "events")
    first = typed_events(data.log(spark, {"ts": 1}, {"ts": 3, "level": "paid"}))
    second = typed_events(data.log(spark, {"ts": 2, "firstName": "Li"}, {"userId": "9", "ts": 2}))
    for batch, log in enumerate((first, second)):
        for _ in range(2):
            merge_users_batch(log, base, batch)
            append_batch(log, appended, batch)
    assert rows(users_now(spark, base), "user_id", "first_name", "level") == [
        (8, "Lily", "paid"), (9, "Lily", "free")
    ]
    assert read_batches(spark, appended, STAGING_EVENTS).count() == 4
    with pytest.raises(ValueError):
        users_now(spark, str(tmp_path / "nothing"))


def test_incremental_and_batch_loads_agree(spark, raw, tmp_path):
    catalog = data.songs(spark, *SONGS)
    found = load_activity_files(
        spark, raw[1], catalog, str(tmp_path / "inc"), str(tmp_path / "progress"), files_per_batch=1
    )
    whole = loads.load_star(spark, *raw, "keyed")
    for name in ("users", "time", "songplay"):
        assert rows(found[name].drop("songplay_id")) == rows(whole[name].drop("songplay_id")), name
    assert rows(found["songplay"], "songplay_id") == [(1,), (2,), (3,)]


def test_corrupt_lines_do_not_stop_a_scan(spark, tmp_path):
    add_file(tmp_path / "in", "a.json", {"ts": 1})
    with (tmp_path / "in" / "a.json").open("a") as f:
        f.write("{broken\n")
    assert read_json(spark, str(tmp_path / "in"), LOG_FILE).count() == 2


def test_broken_lines_fail_a_load_or_are_set_aside(spark, tmp_path):
    add_file(tmp_path / "log", "a.json", {"ts": 1, "itemInSession": 3}, {"ts": 2})
    with (tmp_path / "log" / "a.json").open("a") as f:
        f.write("{broken\n")
    add_file(tmp_path / "songs", "s.json", {"song_id": "S1"})
    paths = str(tmp_path / "songs"), str(tmp_path / "log")
    with pytest.raises(Exception, match="cannot load"):
        loads.stage(spark, *paths, str(tmp_path / "failed"))
    out = str(tmp_path / "out")
    events, songs = loads.stage(spark, *paths, out, bad="quarantine")
    assert rows(events, "ts") == [(1,)] and songs.count() == 1
    aside = spark.read.parquet(f"{out}/quarantine/staging_events")
    assert rows(aside, "fault", "_corrupt_record") == [
        ("itemInSession must not be null", None), ("malformed line", "{broken")
    ]


def test_bad_csv_rows_fail_a_load_or_are_set_aside(spark, tmp_path):
    event_csv(tmp_path / "in" / "a.txt", {}, {4: "oops"}, {0: ""}, {13: "two\nlines", 4: "5"})
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    with pytest.raises(Exception, match="cannot load"):
        loads.load_lookup_tables(spark, source, str(tmp_path / "failed"))
    tables = loads.load_lookup_tables(spark, source, out, bad="quarantine")
    assert rows(tables["session_library"], "item_in_session") == [(4,)]
    faults = [r.fault for r in spark.read.parquet(f"{out}/quarantine/staging").collect()]
    assert len(faults) == 3 and "itemInSession must be a whole number" in faults
    whole = loads.load_lookup_tables(spark, source, str(tmp_path / "whole"), bad="quarantine", multiline=True)
    assert rows(whole["session_library"], "item_in_session", "song_title") == [(4, "Song"), (5, "two\nlines")]


def test_another_progress_folder_is_refused(spark, raw, tmp_path):
    catalog, out = data.songs(spark, *SONGS), str(tmp_path / "inc")
    found = load_activity_files(spark, raw[1], catalog, out, str(tmp_path / "progress"))
    with pytest.raises(ValueError, match="another progress folder"):
        load_activity_files(spark, raw[1], catalog, out, str(tmp_path / "anew"))
    again = load_activity_files(spark, raw[1], catalog, out, str(tmp_path / "progress"))
    for name in found:
        assert rows(found[name]) == rows(again[name])


def test_a_batch_that_not_all_tables_have_is_not_read(spark, raw, tmp_path):
    catalog, out = data.songs(spark, *SONGS), str(tmp_path / "inc")
    before = load_activity_files(spark, raw[1], catalog, out, str(tmp_path / "progress"))
    seen = {name: rows(df) for name, df in before.items()}
    # the next batch dies between two tables
    log = typed_events(data.log(spark, {"userId": "77", "ts": 5}))
    merge_users_batch(log, f"{out}/users", 7)
    append_batch(spark.read.parquet(f"{out}/time/batch=0"), f"{out}/time", 7)
    assert {name: rows(df) for name, df in activity_tables(spark, out).items()} == seen


def test_the_catalog_is_reduced_once_for_all_batches(spark, tmp_path, monkeypatch):
    catalog = data.songs(spark, {}, {"song_id": "S0"}, {"song_id": "S2", "title": "other"})
    data.log(spark, *({"itemInSession": i, "song": s} for i, s in enumerate(["Setanta matins", "other", "none"] * 4))
             ).repartition(4).write.json(str(tmp_path / "log"))
    seen, build = [], star.songplays
    monkeypatch.setattr(star, "songplays", lambda log, songs, **how: seen.append((songs, how["match"])) or build(log, songs, **how))
    tables = load_activity_files(spark, str(tmp_path / "log"), catalog, str(tmp_path / "out"), str(tmp_path / "progress"),
                                 files_per_batch=1)
    assert len(seen) > 1 and {how for _, how in seen} == {"all"} and len({id(songs) for songs, _ in seen}) == 1
    assert sorted(r.song_id for r in tables["songplay"].collect()) == ["S0"] * 4 + ["S2"] * 4
