"""As-of joins, sessions by gap, windows of a stream, sketches and sums over groups."""

import random
from collections import Counter, defaultdict
from datetime import datetime
from statistics import median

import pytest
from pyspark.sql import functions as F

from playlake.operators import asof_join
from playlake.plans import reports, star
from playlake.streaming import load_windowed_counts, windowed_counts
from tests import data
from tests.data import rows


def brute_asof(left, right):
    out = []
    for key, at, tag in left:
        known = [(t, v) for k, t, v in right if k == key is not None and t is not None and at is not None and t <= at]
        out.append((key, at, tag, max(known)[1] if known else None))
    return Counter(out)


@pytest.mark.parametrize("slice_of_time", [1, 10, 1000])
def test_asof_join_equals_brute_force(spark, slice_of_time):
    chance = random.Random(slice_of_time)
    some = lambda n: [(chance.choice(["a", "b", "c", None]), chance.choice([None, *range(-30, 60)]), i) for i in range(n)]
    left, right = some(150), [(k, t, f"v{i % 9}") for k, t, i in some(60)]
    got = asof_join(spark.createDataFrame(left, "k string, t long, tag int"), spark.createDataFrame(right, "k string, t long, v string"),
                    ["k"], "t", ["v"], slice_of_time=slice_of_time)
    assert Counter(map(tuple, got.collect())) == brute_asof(left, right)


def test_a_hot_key_is_joined_in_many_tasks(spark, settings):
    settings({"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"})
    left = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    right = spark.range(0, 20_000, 7).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    found = asof_join(left, right, ["k"], "t", ["v"], slice_of_time=500)
    assert found.filter("v <> t - t % 7").isEmpty() and found.count() == 20_000
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per_task) >= 8 and max(per_task) < 6000


def test_levels_at_plays(spark):
    log = data.log(spark, {"ts": 10, "level": "free", "page": "Home"}, {"ts": 20, "level": "x"}, {"ts": 30, "level": "paid", "page": "Home"},
                   {"ts": 30, "level": "x"}, {"ts": 5, "level": "x"}, {"ts": 90_000_000, "level": "x"})
    found = star.level_at_plays(log, log.filter("page = 'Home'"))
    assert rows(found, "ts", "level") == [(5, None), (20, "free"), (30, "paid"), (90_000_000, "paid")]


def test_sessions_close_after_the_gap(spark, zone):
    minute = 60_000
    log = data.log(spark, {"ts": 0}, {"ts": 30 * minute}, {"ts": 60 * minute + 1, "page": "Home"}, {"ts": 90 * minute + 2},
                   {"ts": 0, "userId": "9"}, {"ts": 0, "userId": ""})
    found = rows(star.sessions_by_gap(log, "30 minutes"), "user_id", "lines", "plays", "first_moment")
    assert found == [(8, 1, 0, datetime(1970, 1, 1, 1, 0, 0, 1000)), (8, 1, 1, datetime(1970, 1, 1, 1, 30, 0, 2000)),
                     (8, 2, 2, datetime(1970, 1, 1)), (9, 1, 1, datetime(1970, 1, 1))]


def test_windows_of_a_stream_count_each_line_once(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("log", "out", "progress"))
    hour = 3_600_000

    def deliver(name, *times):
        data.log(spark, *({"ts": t, "itemInSession": t} for t in times)).coalesce(1).write.json(f"{source}/{name}")
        found = load_windowed_counts(spark, source, out, progress, window="1 hour", late="2 hours", files_per_batch=1)
        return dict((r.window_start.hour, r.plays) for r in found.collect())

    assert deliver("a", 1, 2, hour + 1, 3 * hour) == {0: 2}  # the watermark is at 1:00
    assert deliver("b", hour + 1, hour + 2, 3 * hour, 5 * hour) == {0: 2, 1: 2}  # one repeated, one more in time
    assert deliver("c", 3, 2 * hour, 3 * hour + 6, 6 * hour) == {0: 2, 1: 2, 3: 2}  # 3 and 2:00 come too late
    assert deliver("d", 9 * hour) == {0: 2, 1: 2, 3: 2, 5: 1, 6: 1}


def test_windows_of_a_table_are_those_of_a_stream(spark):
    log = data.log(spark, *({"ts": t, "itemInSession": t} for t in (1, 2, 2, 3_600_001)))
    assert sorted(r.plays for r in windowed_counts(log, "1 hour", "2 hours").collect()) == [1, 2]


def test_sketches_of_days_merge_to_months(spark, zone):
    fact = spark.range(60_000).select(
        F.timestamp_add("HOUR", (F.col("id") % 700).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("start_time"),
        F.when(F.col("id") % 3 == 0, "paid").otherwise("free").alias("level"), (F.col("id") % 20_011).alias("user_id"))
    days = reports.daily_user_sketches(fact)
    assert days.count() == 60
    assert max(r.n for r in days.select(F.length("users").alias("n")).collect()) < 5000  # a bounded size
    about = {r.level: r.users for r in reports.users_of_months(days).collect()}
    exact = {r.level: r.n for r in fact.groupBy("level").agg(F.count_distinct("user_id").alias("n")).collect()}
    for level, n in exact.items():
        assert abs(about[level] - n) <= 4 * reports.SKETCH_ERROR * n


def test_sums_over_groups_equal_brute_force(spark, zone):
    chance = random.Random(4)
    log = [{"ts": chance.randrange(90) * 86_400_000, "location": chance.choice("XY"), "level": chance.choice(["free", None]),
            "length": float(chance.randrange(20)), "itemInSession": i} for i in range(200)] + [{"page": "Home"}]
    groups = defaultdict(list)
    for r in log[:-1]:
        month = (datetime(1970, 1, 1).toordinal() + r["ts"] // 86_400_000)
        month = datetime.fromordinal(month).date().replace(day=1)
        for key in ((r["location"], r["level"], month, 0), (r["location"], r["level"], None, 1), (r["location"], None, None, 3),
                    (None, None, None, 7)):
            groups[key].append(r["length"])
    want = Counter((*key, len(v), float(median(v))) for key, v in groups.items() if len(v) >= 12)
    got = reports.play_rollup(data.log(spark, *log), least=12)
    assert Counter(map(tuple, got.collect())) == want


def test_the_stream_files_are_built_by_many_tasks(spark, monkeypatch):
    """``coalesce(1)`` lets one task read the whole table for each file."""
    from playlake.queries import QUERIES, moments

    def refuse(self, n):
        raise AssertionError("one task reads all")

    monkeypatch.setattr(moments, "load_windowed_counts", lambda spark, source, *a, **k: spark.read.text(f"{source}/*"))
    monkeypatch.setattr(type(spark.range(0)), "coalesce", refuse)
    files = QUERIES["windowed_play_counts"](spark, "/root/testdata/sf0.001").inputFiles()
    assert len(files) == 3
