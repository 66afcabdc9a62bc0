"""Properties of the physical plans that decide how a query behaves on large, skewed data."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playlake.operators import (
    first_per_key,
    last_per_key,
    latest_per_key,
    merge_fields,
    resolve_all,
    resolve_first,
    top_k,
    top_k_per_group,
)
from playlake.plans import keyed, reports, star
from playlake.queries import ORACLE, QUERIES, intake, lookups, roles, scans, upkeep
from playlake.schemas import LOG_FILE, SESSION_LIBRARY, SONGPLAY
from playlake.settings import ADAPTIVE, configure
from playlake.sources import read_parquet, write_keyed, write_parquet
from playlake.streaming import each_new_file
from playlake.workspace import scratch_path
from tests import data

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def executed(df) -> str:
    """The final adaptive plan, after running the query."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def logs(spark):
    return spark.range(1000).selectExpr(
        "cast(id % 10 AS string) AS userId", "id AS ts", "id AS sessionId", "id AS itemInSession",
        "'a' AS firstName", "'b' AS lastName", "'F' AS gender", "'free' AS level", "'NextSong' AS page",
    )


def test_per_key_choices_prune_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS seq", "'x' AS v")
    for chosen in (
        first_per_key(df, ["k"], ["seq"]),
        latest_per_key(df, "k", "seq", ties="one"),
        top_k_per_group(df, ["k"], ["v"], 5),
    ):
        physical = plan(chosen).split("== Physical Plan ==")[1]
        partial = physical.index("Partial")
        exchange = physical[:partial].rindex("Exchange")
        assert "WindowGroupLimit" in physical[exchange:partial]


def test_aggregates_combine_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS lo", "id AS hi", "'x' AS v", "'y' AS w")
    merged = plan(merge_fields(df, ["k"], first={"lo": ["v"]}, last={"hi": ["w"]}))
    assert "partial_min" in merged and "partial_max" in merged
    assert "TakeOrderedAndProject" in plan(top_k(df, ["k"], 2))
    assert "partial_count" in plan(top_k(df, ["k"], 2))


def test_latest_rows_take_a_second_scan_of_two_columns_only(spark, tmp_path):
    path = str(tmp_path / "log")
    logs(spark).write.parquet(path)
    physical = plan(star.users_latest(spark.read.parquet(path))).split("== Physical Plan ==")[1]
    read = re.findall(r"ReadSchema: struct<([^>]*)>", physical)
    assert sorted(len(columns.split(",")) for columns in read) == [2, 6]
    assert "partial_max" in physical and "SPARK_PARTITION_ID" not in physical


def hot_song(spark, tmp_path):
    """A log with one song on a third of all lines, and a catalog, both as stored tables."""
    log = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('song ', id)) AS song", "'artist' AS artist", "1.0D AS length",
        "'NextSong' AS page", "uuid() AS location",
    ).repartition(16)
    catalog = spark.range(300_000).selectExpr(
        "if(id = 0, 'hot', concat('song ', id)) AS title", "'artist' AS artist_name",
        "1.0D AS duration", "cast(id AS string) AS song_id", "'a' AS artist_id",
    )
    write_parquet(log, str(tmp_path / "log"))
    write_parquet(catalog, str(tmp_path / "catalog"))
    return spark.read.parquet(str(tmp_path / "log")), spark.read.parquet(str(tmp_path / "catalog"))


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.mark.parametrize("resolve", [resolve_all, resolve_first])
def test_a_hot_song_is_split_over_tasks(spark, tmp_path, settings, resolve):
    settings(SKEW)
    log, catalog = hot_song(spark, tmp_path)
    joined = resolve(log, catalog).select("location", "song_id")
    assert "skew=true" in executed(joined)
    # Two thirds of the lines name their own song, a third the hot one.
    assert joined.count() == 300_000


def test_rows_joined_on_part_of_the_key_are_still_pruned_before_a_shuffle(spark, settings):
    """A per-key choice must not go on from a join on one key column with all of its rows."""
    settings(SKEW | ADAPTIVE)
    left = spark.range(1000).selectExpr("id % 5 AS k", "id % 7 AS item", "id AS seq")
    right = spark.range(5).selectExpr("id AS k", "'x' AS v")
    chosen = last_per_key(left.join(right, "k"), ["k", "item"], ["seq"])
    physical = plan(chosen).split("== Physical Plan ==")[1]
    final, partial = physical.index("Final"), physical.index("Partial")
    assert "Exchange hashpartitioning(k" in physical[final:partial]
    distinct = plan(left.join(right, "k").select("k", "item", "v").distinct())
    between = distinct.split("== Physical Plan ==")[1].split("SortMergeJoin")[0]
    assert "Exchange hashpartitioning(k" in between


def test_copies_of_a_latest_row_are_split_over_tasks(spark, tmp_path, settings):
    """A third of the log is one line, which is its user's latest; all copies are kept."""
    settings(SKEW | ADAPTIVE)
    spark.range(300_000).selectExpr(
        "if(id % 3 = 0, -1, id) AS user", "if(id % 3 = 0, 9, id) AS ts", "uuid() AS note",
    ).repartition(16).write.parquet(str(tmp_path / "log"))
    latest = latest_per_key(spark.read.parquet(str(tmp_path / "log")), "user", "ts")
    assert "skew=true" in executed(latest)
    assert latest.count() == 300_000


def test_counting_first_sends_a_hot_song_to_the_join_as_one_row(spark, tmp_path, settings):
    settings(SKEW)
    log, catalog = hot_song(spark, tmp_path)
    physical = plan(reports.play_counts(log, catalog)).split("== Physical Plan ==")[1]
    assert physical.index("SortMergeJoin") < physical.index("partial_count")
    top = reports.top_songs(reports.play_counts(log, catalog), catalog, 1)
    assert top.first().asDict() == {"song_id": "0", "title": "hot", "plays": 100_000}


def test_repeated_names_are_combined_before_they_are_ranked(spark):
    """An artist's name stands on each of its songs: only different ones reach the ranking's sort."""
    counts = spark.range(100).selectExpr("id % 3 AS location", "cast(id % 9 AS string) AS artist_id", "id AS plays")
    artists = spark.range(1000).selectExpr("cast(id % 9 AS string) AS artist_id", "if(id < 9, null, 'a') AS name")
    top = reports.top_artists_by_country(counts, artists)
    physical = plan(top).split("== Physical Plan ==")[1]
    assert physical.index("WindowGroupLimit") < physical.index("HashAggregate") < physical.index("Join")
    assert {r.name for r in top.collect()} == {None}  # a missing name comes first, as before


def test_no_broadcast_of_a_large_catalog(spark, tmp_path, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "1KB",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "1KB"})
    log, catalog = hot_song(spark, tmp_path)
    assert "Broadcast" not in executed(resolve_all(log, catalog))


def test_lookups_push_their_key_into_the_scan(spark, tmp_path):
    df = spark.range(1000).selectExpr(
        "id % 100 AS session_id", "id AS item_in_session", "'a' AS artist", "'s' AS song_title",
        "cast(1 AS float) AS song_length",
    )
    write_keyed(df, SESSION_LIBRARY, str(tmp_path / "t"), files=4)
    stored = read_parquet(spark, str(tmp_path / "t"), SESSION_LIBRARY.schema)
    physical = plan(keyed.session_item(stored, 7, 107))
    assert "EqualTo(session_id,7)" in physical and "EqualTo(item_in_session,107)" in physical


def test_a_month_report_prunes_partitions_and_columns(spark, tmp_path):
    fact = spark.range(100).selectExpr(
        "id AS songplay_id", "timestamp_ntz'2018-11-01' + make_dt_interval(cast(id AS int)) AS start_time",
        "id AS user_id", "'paid' AS level", "'s' AS song_id", "'a' AS artist_id", "id AS session_id",
        "'x' AS location", "'y' AS user_agent",
    )
    write_parquet(fact, str(tmp_path / "fact"))
    physical = plan(reports.paid_users(read_parquet(spark, str(tmp_path / "fact"), SONGPLAY.schema), 2018, 12))
    schema = re.search(r"ReadSchema: (\S+)", physical).group(1)
    assert schema == "struct<start_time:timestamp_ntz,user_id:bigint,level:string>"
    assert "GreaterThanOrEqual(start_time" in physical and "EqualTo(level,paid)" in physical


def test_the_time_distinct_groups_by_the_moment_alone(spark):
    optimized = plan(star.time_dimension(star.log_times(logs(spark)))).split("== Optimized")[1]
    assert re.search(r"Aggregate \[start_time#\d+\], \[start_time#\d+, hour\(", optimized)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_forces_pairs_of_rows(spark, name):
    """No cartesian products, and no Python in any plan."""
    if name.startswith(("load_", "incremental_", "scan_", "stage_")):
        pytest.skip("runs jobs to build its plan; covered by the oracle test")
    physical = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical
    assert "Python" not in physical and "InPandas" not in physical


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert not any(n.startswith(("pipeline", "op")) for n in QUERIES)


class Session:
    """Stands in for a session with the given settings."""

    def __init__(self, **values):
        self.conf = self
        self.values = {name.replace("_", "."): value for name, value in values.items()}

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_scratch_folders_follow_the_session_setting():
    shared = Session(spark_checkpoint_dir="hdfs://host/shared/", spark_master="yarn")
    path = scratch_path(shared, "x")
    assert path.startswith("hdfs://host/shared/playlake/x-")
    assert path != scratch_path(shared, "x")
    assert "/playlake/x-" in scratch_path(Session(spark_master="local[8]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="yarn"), "x")


def test_raw_files_are_small_and_several(spark):
    """They are written whole by every load: compressed, and without a shuffle of their wide rows."""
    for role, pattern in (("catalog", "*.json.gz"), ("activity", "*.json.gz"), ("event_csv", "*.csv.gz")):
        path = Path(roles.raw_files(configure(spark.newSession()), "/root/testdata/sf0.01", role))
        assert len(list(path.glob(pattern))) == len(list(path.glob("part-*"))) >= (1 if role == "catalog" else 2)
    plan = roles.activity(spark, SF, spread=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RepartitionByExpression") and plan.count("RepartitionByExpression") == 1


def test_lines_of_compressed_files_are_spread(spark, tmp_path):
    data.log(spark, *({"ts": i, "itemInSession": i} for i in range(200))).coalesce(1).write.json(
        str(tmp_path / "log"), compression="gzip")
    seen = []
    each_new_file(spark, str(tmp_path / "log"), LOG_FILE, str(tmp_path / "progress"),
                  lambda rows, batch: seen.append((rows.rdd.getNumPartitions(), rows.count())), spread=True)
    assert seen == [(spark.sparkContext.defaultParallelism, 200)]


def test_spread_lines_stay_with_their_neighbours(spark, tmp_path):
    """Neighbours are alike: dealt one by one, the lines compress worse in the shuffle."""
    data.log(spark, *({"ts": i, "itemInSession": i} for i in range(1024))).coalesce(1).write.json(
        str(tmp_path / "log"), compression="gzip")
    seen = []
    each_new_file(spark, str(tmp_path / "log"), LOG_FILE, str(tmp_path / "progress"),
                  lambda rows, batch: seen.extend(rows.select(F.spark_partition_id(), "ts").collect()), spread=True)
    task = dict((ts, part) for part, ts in seen)
    assert sorted(task) == list(range(1024)) == sorted(ts for _, ts in seen)
    assert len(set(task.values())) > 1
    assert all(len({task[ts] for ts in range(at, at + 64)}) == 1 for at in range(0, 1024, 64))


def test_the_two_files_to_report_are_written_from_a_compressed_table(spark, tmp_path, monkeypatch, settings):
    settings({"spark.sql.session.timeZone": "UTC"})
    monkeypatch.setattr(scans, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    (report,) = QUERIES["scan_files_report"](spark, SF).collect()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert report.asDict() == {"total_rows": lines, "files": 3, "empty_files": 1}
    columns = LOG_FILE.fieldNames()
    written = spark.read.schema(LOG_FILE).option("recursiveFileLookup", True).json(f"{tmp_path}/report/log")
    counts = [r["count"] for r in written.groupBy("_metadata.file_path").count().collect()]
    assert len(counts) == 2 and abs(counts[0] - counts[1]) <= 0.2 * lines
    log = roles.activity(spark, SF).select(columns)
    assert written.select(columns).exceptAll(log).isEmpty() and log.exceptAll(written.select(columns)).isEmpty()
    halves = list((tmp_path / "report-halves").glob("half=*/part-*"))
    assert {h.parent.name for h in halves} == {"half=0", "half=1"} and all(".zstd." in h.name for h in halves)


def test_the_two_files_to_report_are_compressed(spark, tmp_path, monkeypatch, settings):
    """As plain text they are most of what the query writes."""
    settings({"spark.sql.session.timeZone": "UTC"})
    monkeypatch.setattr(scans, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    (report,) = QUERIES["scan_files_report"](spark, SF).collect()
    roles.activity(spark, SF).select(LOG_FILE.fieldNames()).write.json(f"{tmp_path}/plain")
    plain = spark.read.text(f"{tmp_path}/plain")
    files = list((tmp_path / "report" / "log").glob("*/part-*"))
    assert len(files) == 2 and all(f.suffix == ".gz" for f in files)
    written = spark.read.text([str(f) for f in files])
    assert written.count() == plain.count() == report.total_rows
    assert written.exceptAll(plain).isEmpty()
    size = sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*"))
    assert 5 * sum(f.stat().st_size for f in files) < size


@pytest.mark.parametrize(("module", "query"), [(intake, "stage_quarantine"), (upkeep, "incremental_quarantine")])
def test_broken_lines_are_written_compressed_in_as_many_files_as_they_need(spark, tmp_path, monkeypatch, module, query):
    monkeypatch.setattr(module, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    QUERIES[query](spark, SF)
    raw = tmp_path / {"stage_quarantine": "broken/log", "incremental_quarantine": "raw-broken"}[query]
    files = list(raw.glob("part-*"))
    assert files and len(files) < 4 and all(f.suffix == ".gz" for f in files)


def test_the_staged_log_is_joined_once(spark, monkeypatch):
    built = []
    monkeypatch.setattr(upkeep, "activity", lambda *a, **k: built.append(a) or roles.activity(*a, **k))
    monkeypatch.setattr(lookups, "activity", upkeep.activity)
    assert QUERIES["staging_lifecycle"](spark, SF).count() == 5
    assert len(built) == 1


def test_the_log_to_compact_comes_compressed_in_files_for_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upkeep, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    assert QUERIES["incremental_compacted"](spark, SF).count() > 0
    files = list((tmp_path / "raw-compacted").glob("part-*"))
    assert len(files) >= 5 * spark.sparkContext.defaultParallelism and all(f.suffix == ".gz" for f in files)
    assert 5 <= len(list((tmp_path / "progress" / "commits").glob("[0-9]*"))) <= 9
