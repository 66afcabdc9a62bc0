import random

import pytest
from pyspark.sql import functions as F

from playlake.operators import (
    append_unique,
    assert_unique,
    dense_key,
    distinct_rows,
    enforce_required,
    first_per_key,
    hash_key,
    insert_absent,
    known_users,
    last_per_key,
    latest_per_key,
    merge_fields,
    plays,
    read_numbered,
    resolve_all,
    resolve_first,
    sparse_key,
    split_valid,
    surrogate_key,
    top_k,
    top_k_per_group,
    with_artist,
    write_numbered,
)
from tests import data
from tests.data import rows


def test_row_filters(spark):
    log = data.log(spark, {}, {"page": "Home"}, {"userId": ""}, {"userId": None}, {"artist": None},
                   {"artist": ""})
    assert plays(log).count() == 5
    assert known_users(log).count() == 4
    assert with_artist(log).count() == 4
    assert known_users(log.withColumn("userId", F.col("userId").try_cast("bigint"))).count() == 4


def test_valid_and_rejected_rows_make_up_all_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "id int, name string")
    valid, rejected = split_valid(df, ["id", "name"])
    assert rows(valid) == [(1, "a")]
    assert rows(rejected) == [(None, "b"), (2, None)]


def test_required_columns_fail_the_job_that_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, name string")
    assert rows(enforce_required(df, ["id"], "drop")) == [(1, "a")]
    assert rows(enforce_required(df, ["name"])) == rows(df)
    assert enforce_required(df, ["id"]).dtypes == df.dtypes
    with pytest.raises(Exception, match="id must not be null"):
        enforce_required(df, ["id"]).write.parquet(str(tmp_path / "out"))


def test_distinct_keeps_spellings_and_first_does_not(spark):
    df = spark.createDataFrame(
        [("A1", "Beck", 2), ("A1", "BECK", 1), ("A1", "Beck", 3), ("A2", None, 4)],
        "id string, name string, seq int",
    )
    assert rows(distinct_rows(df, ["id", "name"])) == [("A1", "BECK"), ("A1", "Beck"), ("A2", None)]
    assert rows(first_per_key(df, ["id"], ["seq"]), "id", "name") == [("A1", "BECK"), ("A2", None)]
    assert rows(last_per_key(df, ["id"], ["seq"]), "id", "name") == [("A1", "Beck"), ("A2", None)]


def test_latest_rows_with_and_without_ties(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, 5, "d"), (None, 99, "e"), (3, None, "f")],
        "id int, ts int, name string",
    )
    assert rows(latest_per_key(df, "id", "ts"), "id", "name") == [(1, "b"), (1, "c"), (2, "d")]
    one = latest_per_key(df, "id", "ts", ties="one", tie_break=["name"])
    assert rows(one, "id", "name") == [(1, "c"), (2, "d")]
    with pytest.raises(ValueError):
        latest_per_key(df, "id", "ts", ties="some")


def test_latest_equals_the_join_with_its_own_maximum(spark):
    rng = random.Random(1)
    values = [(rng.randrange(20), rng.randrange(30), i) for i in range(2000)]
    df = spark.createDataFrame(values, "id int, ts int, n int")
    best = {}
    for key, ts, _ in values:
        best[key] = max(best.get(key, ts), ts)
    assert rows(latest_per_key(df, "id", "ts")) == sorted(v for v in values if v[1] == best[v[0]])


def test_merged_fields_do_not_depend_on_how_batches_are_cut(spark):
    rng = random.Random(2)
    values = [(rng.randrange(9), i, i, f"n{rng.randrange(5)}", rng.choice("fp")) for i in range(300)]
    rng.shuffle(values)
    df = spark.createDataFrame(values, "id int, lo int, hi int, name string, level string")

    def merge(d):
        return merge_fields(d, ["id"], first={"lo": ["name"]}, last={"hi": ["level"]})

    whole = rows(merge(df))
    first, second = df.filter("lo % 3 = 0"), df.filter("lo % 3 <> 0")
    by_batch = merge(merge(first).unionByName(merge(second)))
    replayed = merge(by_batch.unionByName(merge(second)))
    assert rows(by_batch) == whole
    assert rows(replayed) == whole
    for key, name, level, lo, hi in whole:
        mine = sorted(v[1:] for v in values if v[0] == key)
        assert (name, level, lo, hi) == (mine[0][2], mine[-1][3], mine[0][0], mine[-1][1])


def test_insert_absent_and_unique_append(spark):
    old = spark.createDataFrame([("a", "old")], "id string, name string")
    new = spark.createDataFrame(
        [("a", "new", 1), ("b", "late", 3), ("b", "early", 2)], "id string, name string, seq int"
    )
    assert rows(insert_absent(old, new, ["id"], ["seq"])) == [("b", "early", 2)]
    assert rows(insert_absent(None, new, ["id"], ["seq"]), "id", "name") == [
        ("a", "new"), ("b", "early")
    ]
    with pytest.raises(ValueError, match="duplicate id"):
        assert_unique(new, ["id"])
    with pytest.raises(ValueError, match="'a'"):
        append_unique(old, new.filter("id = 'a'"), ["id"])
    assert append_unique(old, new.filter("seq = 3"), ["id"]).count() == 1


def test_matching_all_or_first(spark):
    log = data.log(spark, {}, {"song": None}, {"song": "absent"}, {"length": 1.0})
    songs = data.songs(spark, {"song_id": "S2", "artist_id": "A2"}, {}, {"song_id": "S3", "title": None})
    assert rows(resolve_all(log, songs), "song_id", "artist_id") == [("S1", "A1"), ("S2", "A2")]
    assert rows(resolve_first(log, songs), "song_id", "artist_id") == [("S1", "A1")]


def test_lengths_match_exactly_unless_a_scale_is_given(spark):
    log = data.log(spark, {"length": 269.583221})
    songs = data.songs(spark, {})
    assert resolve_all(log, songs).count() == 0
    assert resolve_all(log, songs, scale=5).count() == 1
    assert resolve_first(log, songs, scale=5).count() == 1


@pytest.mark.parametrize("copies", [1, 700])
def test_dense_key_counts_every_row_once_in_order(spark, copies):
    values = [(i % 7, str(i)) for i in range(500)] + [(3, "hot")] * copies
    df = spark.createDataFrame(values, "n int, name string").repartition(6)
    keyed = dense_key(df, "id", ["n", "name"], start=0)
    found = rows(keyed)
    assert keyed.columns == ["id", "n", "name"]
    assert [r[0] for r in found] == list(range(len(values)))
    assert [r[1:] for r in found] == sorted(values)
    assert rows(keyed) == found
    arrival = dense_key(df, "id")
    assert [r[0] for r in rows(arrival)] == list(range(1, len(values) + 1))
    assert rows(arrival.drop("id")) == sorted(values)


def test_dense_key_of_no_rows(spark):
    assert dense_key(spark.createDataFrame([], "n int"), "id", ["n"]).count() == 0


def test_sparse_and_hash_keys(spark):
    df = spark.range(1000).withColumnRenamed("id", "n").repartition(5)
    assert sparse_key(df, "id").select("id").distinct().count() == 1000
    hashed = hash_key(df, "id", ["n"])
    assert hashed.select("id").distinct().count() == 1000
    assert rows(hashed) == rows(surrogate_key(df.coalesce(1), "id", "hash"))
    with pytest.raises(ValueError):
        surrogate_key(df, "id", "random")


def test_top_k_breaks_ties_by_key_and_adds_up_counts(spark):
    df = spark.createDataFrame([("x", k) for k in "aabbcd"] + [("y", "d")], "g string, k string")
    top = top_k(df, ["k"], 3)
    assert [tuple(r) for r in top.collect()] == [("a", 2), ("b", 2), ("d", 2)]
    per_group = top_k_per_group(df, ["g"], ["k"], 2)
    assert rows(per_group, "g", "pos", "k", "plays") == [
        ("x", 1, "a", 2), ("x", 2, "b", 2), ("y", 1, "d", 1)
    ]
    counted = df.groupBy("g", "k").agg(F.count("*").alias("plays"))
    assert top_k(counted, ["k"], 3).collect() == top.collect()


def test_ids_are_added_on_reading_and_stay(spark, tmp_path):
    df = spark.range(0, 500, 1, 7).filter("id % 5 <> 0 AND id > 100").selectExpr("id AS v")
    write_numbered(df, str(tmp_path / "t"))
    first = read_numbered(spark, str(tmp_path / "t"), "n", df.schema, start=10)
    assert first.columns == ["n", "v"]
    assert sorted(r.n for r in first.collect()) == list(range(10, 10 + df.count()))
    assert sorted(first.collect()) == sorted(read_numbered(spark, str(tmp_path / "t"), "n", df.schema, start=10).collect())
    write_numbered(df.limit(0), str(tmp_path / "none"))
    assert read_numbered(spark, str(tmp_path / "none"), "n", df.schema).count() == 0
