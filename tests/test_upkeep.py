"""Faulty lines in incremental loads, states in buckets, compaction, bucketed tables, Bloom filters."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playlake import sources
from playlake.operators import table_changes
from playlake.plans import keyed, loads, quality
from playlake.schemas import LOG_FILE, SONG_LIBRARY, SONGPLAY, STAGING_EVENTS, TIME, USERS, layout
from playlake.schemas import Table as Layout
from playlake.streaming import (
    activity_tables,
    append_batch,
    compact,
    compact_activity,
    expire_buckets,
    load_activity_files,
    merge_into_buckets,
    merge_users_batch,
    quarantined,
    read_batches,
    read_buckets,
    users_now,
)
from tests import data
from tests.data import rows


def scanned_rows(df):
    """The rows that the scan of a plan gave when it ran; not for adaptive plans."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def lines(*changed):
    return [json.dumps({**dict(zip(LOG_FILE.fieldNames(), [None] * 18, strict=False)), **data._LOG, **c}) for c in changed]


@pytest.fixture
def broken(spark, tmp_path):
    """Three files; two hold faulty lines."""
    log = tmp_path / "log"
    log.mkdir()
    good = lines({"ts": 1}, {"ts": 2, "itemInSession": 1}, {"ts": 3, "userId": "9", "itemInSession": 2})
    (log / "a.json").write_text("\n".join([good[0], good[1][:60], "\t", ""]))
    (log / "b.json").write_text("\n".join([good[2], *lines({"itemInSession": None, "ts": 4})]))
    (log / "c.json").write_text(f"[{good[1]}, {good[0]}]\n")
    return str(log), str(tmp_path / "out"), str(tmp_path / "progress")


def test_faulty_lines_are_set_aside_batch_by_batch(spark, broken):
    source, out, progress = broken
    catalog = data.songs(spark, {})
    tables = load_activity_files(spark, source, catalog, out, progress, files_per_batch=1, bad="quarantine", buckets=4)
    assert tables["songplay"].count() == 4 and tables["users"].count() == 2
    assert Counter(r.fault for r in quarantined(spark, out).collect()) == {
        "malformed line": 1, "itemInSession must not be null": 1}
    kept = quarantined(spark, out).filter("fault like 'item%'").first()
    assert json.loads(kept.row)["ts"] == 4
    assert quarantined(spark, out).filter("fault like 'mal%'").first()["_corrupt_record"].startswith('{"artist"')
    # nothing new: nothing changes
    again = load_activity_files(spark, source, catalog, out, progress, files_per_batch=1, bad="quarantine", buckets=4)
    assert again["songplay"].count() == 4 and quarantined(spark, out).count() == 2


def test_a_faulty_line_fails_its_batch_until_it_is_mended(spark, broken):
    source, out, progress = broken
    catalog = data.songs(spark, {})
    with pytest.raises(Exception, match="cannot load"):
        load_activity_files(spark, source, catalog, out, progress, buckets=4)
    with pytest.raises(ValueError, match="no completed batch"):
        activity_tables(spark, out)
    with pytest.raises(Exception, match="cannot load"):  # not forgotten
        load_activity_files(spark, source, catalog, out, progress, buckets=4)
    good = lines({"ts": 1}, {"ts": 2, "itemInSession": 1}, {"ts": 3, "itemInSession": 2})
    for name in ("a", "b"):
        Path(source, f"{name}.json").write_text("\n".join(good))
    # the files are those of the failed batch, with their new content
    assert load_activity_files(spark, source, catalog, out, progress, buckets=4)["songplay"].count() == 8
    with pytest.raises(ValueError, match="bad must be"):
        load_activity_files(spark, source, catalog, out, progress, bad="skip")


def test_blank_lines_and_arrays_in_song_files(spark, tmp_path):
    (tmp_path / "s.json").write_text('\t\n  \n[{"song_id": "S1"}, {"song_id": "S2"}]\n{"song_id": "S3"}\n[]\n')
    assert rows(sources.stage_songs(spark, str(tmp_path)), "song_id") == [("S1",), ("S2",), ("S3",)]
    (tmp_path / "t.json").write_text('{"title": "no id"}\n[{"song_id": "S4"}, 5]\n')
    found = sources.checked_songs(spark, str(tmp_path))
    assert Counter(r.fault for r in found.collect()) == {None: 3, "song_id must not be null": 1, "malformed line": 1}
    with pytest.raises(Exception, match="cannot load"):
        sources.stage_songs(spark, str(tmp_path)).collect()


# states in buckets


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "_incoming" not in str(p)}


def test_only_buckets_of_a_batch_are_rewritten(spark, tmp_path):
    base = str(tmp_path / "users")
    log = data.log(spark, *({"userId": str(i), "ts": i, "level": "free"} for i in range(200)))
    merge_users_batch(log, base, 0, buckets=16)
    before = files(f"{base}/data")
    assert len(before) == 16
    merge_users_batch(data.log(spark, {"userId": "7", "ts": 900, "level": "paid"}), base, 1, buckets=16)
    after = files(f"{base}/data")
    assert all(after[f] == t for f, t in before.items())  # untouched, and still there for readers
    assert len(after) == 17
    now = dict(rows(users_now(spark, base), "user_id", "level"))
    assert len(now) == 200 and now[7] == "paid" and now[8] == "free"
    assert dict(rows(users_now(spark, base, 0), "user_id", "level"))[7] == "free"
    # a replay of the batch gives the same states
    merge_users_batch(data.log(spark, {"userId": "7", "ts": 900, "level": "paid"}), base, 1, buckets=16)
    assert dict(rows(users_now(spark, base), "user_id", "level")) == now
    expire_buckets(spark, base, keep=1)
    assert len(files(f"{base}/data")) == 16
    assert dict(rows(users_now(spark, base), "user_id", "level")) == now
    with pytest.raises(ValueError, match="16 buckets, not 8"):
        merge_users_batch(log, base, 2, buckets=8)


def test_bucketed_states_of_any_table_and_empty_batches(spark, tmp_path):
    base = str(tmp_path / "counts")
    table = Layout("counts", layout("key string\nn bigint"), key=("key",))
    add = lambda df: df.groupBy("key").agg(F.sum("n").alias("n"))
    none = spark.createDataFrame([], table.schema)
    assert merge_into_buckets(none, base, 0, table, add, 4) == 0
    assert read_buckets(spark, base, table).count() == 0
    total, chance = Counter(), random.Random(1)
    for batch in range(1, 5):
        part = [(chance.choice(["a", "b", "c", None, ""]), chance.randrange(9)) for _ in range(20)]
        for k, n in part:
            total[k] += n
        merge_into_buckets(spark.createDataFrame(part, table.schema), base, batch, table, add, 4)
        expire_buckets(spark, base, keep=2)
        assert dict(rows(read_buckets(spark, base, table))) == total
    assert merge_into_buckets(none, base, 5, table, add, 4) == 0
    assert dict(rows(read_buckets(spark, base, table))) == total


def test_batches_add_to_large_buckets_and_rewrite_them_seldom(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("playlake.streaming.buckets.SMALL_ROWS", 10)
    base = str(tmp_path / "counts")
    table = Layout("counts", layout("key string\nn bigint"), key=("key",))
    add = lambda df: df.groupBy("key").agg(F.sum("n").alias("n"))
    total, written = Counter(), []
    for batch in range(12):
        part = [(str(i), batch + i) for i in (range(100) if batch == 0 else range(batch, batch + 20))]
        for again in range(2 if batch in (0, 3, 6) else 1):  # some are replayed
            merge_into_buckets(spark.createDataFrame(part, table.schema), base, batch, table, add, 1)
        for k, n in part:
            total[k] += n
        written.append(spark.read.parquet(f"{base}/data/version={batch:012d}").count())
        assert dict(rows(read_buckets(spark, base, table, merge=add))) == total
        if batch == 1:
            with pytest.raises(ValueError, match="merge must say"):
                read_buckets(spark, base, table)
        expire_buckets(spark, base, keep=2)
    # the additions of batches 1 to 5, the sixth rewrites: 100 rows, and so on
    assert written == [100, 20, 20, 20, 20, 20, 100, 20, 20, 20, 20, 20]
    assert dict(rows(read_buckets(spark, base, table, up_to=10, merge=add)))["99"] == 99


# compaction


def test_compaction_keeps_the_values_in_fewer_files(spark, tmp_path):
    path = str(tmp_path / "time")
    table = Layout("t", layout("n bigint\nat bigint"))
    make = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("n"), (-F.col("id")).alias("at")).repartition(4)
    for batch in range(6):
        append_batch(make(batch * 10, batch * 10 + 10), path, batch)
    begun = read_batches(spark, path, table)  # a reader from before
    assert compact(spark, path, table, 3, order=["at"], file_bytes=1 << 20) == 4
    assert compact(spark, path, table, 3) == 0
    want = [(i,) for i in range(60)]
    assert rows(read_batches(spark, path, table), "n") == want == rows(begun, "n")
    assert rows(read_batches(spark, path, table, up_to=2), "n") == want[:30]
    assert len(list(Path(path, "_compacted").rglob("*.parquet"))) == 1
    append_batch(make(20, 30), path, 2)  # replayed after it was compacted
    assert rows(read_batches(spark, path, table), "n") == want
    for batch in (6, 7):
        append_batch(make(batch * 10, batch * 10 + 10), path, batch)
    assert compact(spark, path, table, 7, order=["at"]) == 4
    assert rows(read_batches(spark, path, table), "n") == [(i,) for i in range(80)]
    assert {p.name for p in Path(path).glob("batch=*")} == {"batch=4", "batch=5", "batch=6", "batch=7"}
    assert compact(spark, path, table, 7) == 0


def test_compacted_loads_go_on(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("log", "out", "progress"))
    catalog = data.songs(spark, {})
    for part in range(3):
        data.log(spark, *({"ts": part * 100 + i, "itemInSession": i} for i in range(10))).coalesce(1).write.json(f"{source}/{part}")
        tables = load_activity_files(spark, source, catalog, out, progress, buckets=4)
        before = {t.name: rows(tables[t.name]) for t in (USERS, TIME, SONGPLAY)}
        done = compact_activity(spark, out)
        assert done == {"time": 1, "songplay": 1}
        tables = activity_tables(spark, out)
        assert {t.name: rows(tables[t.name]) for t in (USERS, TIME, SONGPLAY)} == before
    assert rows(tables["songplay"], "songplay_id") == [(i,) for i in range(1, 31)]


# layouts


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"})
    name = "t" + tmp_path.name.replace("-", "_")
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("a"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    tables = [sources.write_bucketed(df, f"{name}_{i}", str(tmp_path / str(i)), ["k"], 8) for i, df in enumerate((left, right))]
    joined = tables[0].join(tables[1], "k").groupBy("k").agg(F.sum("b").alias("b"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hash" not in plan and "Sort [" not in plan
    assert rows(joined) == [(k, 40 * k) for k in range(50)]
    assert len(list((tmp_path / "0").glob("*.parquet"))) <= 8
    for i in range(2):
        spark.sql(f"DROP TABLE {name}_{i}")
    plain = left.join(right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" in plain


def test_bloom_filters_skip_row_groups_that_min_and_max_do_not(spark, tmp_path, settings):
    settings({"spark.sql.adaptive.enabled": "false"})
    # more titles than a dictionary holds, which scans would look at instead
    titles = spark.range(300_000).select(
        F.concat(F.lit("title "), F.lpad((F.col("id") * 2).cast("string"), 6, "0")).alias("song_title"),
        (F.col("id") % 97).alias("user_id"), F.lit("x").alias("user"))
    read = {}
    for bloom in ((), ("song_title", "user")):
        path = str(tmp_path / str(len(bloom)))
        sources.write_keyed(titles, SONG_LIBRARY, path, files=2, bloom=bloom)
        found = keyed.listeners(sources.read_parquet(spark, path, SONG_LIBRARY.schema), "title 010001")  # not there
        read[bool(bloom)] = scanned_rows(found)
        assert found.collect() == []
    assert read[False] > 0 and read[True] == 0
    there = keyed.listeners(sources.read_parquet(spark, str(tmp_path / "2"), SONG_LIBRARY.schema), "title 010002")
    assert there.count() == 1


def test_songs_and_users_sorted_by_id(spark, tmp_path):
    data.log(spark, *({"ts": i, "userId": str(i % 7), "itemInSession": i} for i in range(40))).write.json(str(tmp_path / "log"))
    data.songs(spark, *({"song_id": f"S{i}", "artist_id": f"A{i % 5}", "year": 2000 + i % 2} for i in range(30))).write.json(
        str(tmp_path / "songs"))
    want = None
    for by_id in (False, "sorted", True):
        out = tmp_path / f"out-{by_id}"
        tables = loads.load_star(spark, str(tmp_path / "songs"), str(tmp_path / "log"), str(out), "lake", by_id=by_id)
        found = {n: rows(tables[n], *sorted(tables[n].columns)) for n in ("song", "users", "artist")}
        want = want or found
        assert found == want
        folders = {p.name for p in (out / "song").rglob("*=*")}
        assert ("year=2000" in folders) == bool(by_id) and ("artist_id=A1" in folders) == (by_id is True)
        assert bool(list((out / "users").glob("user_id=*"))) == (by_id is True)


def test_ids_added_on_reading_are_those_of_a_load(spark, tmp_path):
    data.log(spark, *({"ts": i * 1000, "itemInSession": i} for i in range(30))).repartition(3).write.json(str(tmp_path / "log"))
    data.songs(spark, {}).write.json(str(tmp_path / "songs"))
    for preset, low in (("keyed", 1), ("warehouse", 0)):
        out = tmp_path / preset
        tables = loads.load_star(spark, str(tmp_path / "songs"), str(tmp_path / "log"), str(out), preset, ids="read")
        assert tables["songplay"].columns == SONGPLAY.columns
        assert rows(tables["songplay"], "songplay_id") == [(i,) for i in range(low, low + 30)]
        assert tables["time"].count() == 30 and not (out / "_scratch").exists()
    with pytest.raises(ValueError, match="ids must be"):
        loads.load_star(spark, "a", "b", str(tmp_path), ids="no")


# checks


def test_columns_as_the_files_have_them(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, "x", None)], "user_id bigint, first_name string, level double")
    found = rows(quality.column_report(df, USERS))
    assert found == [("users", 1, "user_id", "bigint", True, 2), ("users", 2, "first_name", "string", True, 1),
                     ("users", 3, "level", "double", False, 1)]


def test_changes_equal_except_all_both_ways(spark):
    chance = random.Random(2)
    make = lambda: spark.createDataFrame(
        [(chance.choice([1, 2, 3, None]), chance.choice(["a", "b", None])) for _ in range(40)] + [(chance.choice([7, 8]), "x")] * 3,
        "k int, v string")
    old, new = make(), make()
    found = table_changes(old, new, ["k"]).collect()
    bag = lambda df: Counter(map(tuple, df.collect()))
    gone, come = Counter(), Counter()
    for r in found:
        (come if r.change in ("insert", "update_to") else gone)[r.k, r.v] += r.n
    assert come == bag(new.exceptAll(old)) and gone == bag(old.exceptAll(new))
    olds, news = ({r.k for r in df.collect()} for df in (old, new))
    for r in found:
        assert (r.change.startswith("update")) == (r.k in olds and r.k in news)
    assert table_changes(old, old, ["k"]).count() == 0


def test_events_of_a_batch_keep_their_types(spark, broken):
    source, out, progress = broken
    load_activity_files(spark, source, data.songs(spark, {}), out, progress, bad="quarantine", buckets=2)
    events = read_batches(spark, f"{out}/events", STAGING_EVENTS)
    assert events.filter("userId = 8").count() == 4  # the one without an item is there, with its fault beside it
    assert events.filter("userId = 8 AND itemInSession IS NOT NULL").count() == 3


def test_a_compacted_file_has_no_more_rows_than_a_task_can_sort(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("playlake.streaming.compaction.SORT_ROWS", 100, raising=False)
    path, table = str(tmp_path / "t"), Layout("t", layout("at bigint\nnote string"))
    append_batch(spark.range(1000).selectExpr("id AS at", "'equal' AS note"), path, 0)
    assert compact(spark, path, table, 0, order=["at"]) == 1
    assert len(list(Path(path, "_compacted").rglob("*.parquet"))) == 10
    assert rows(read_batches(spark, path, table), "at") == [(i,) for i in range(1000)]
