import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendspark.operators import joins, key_sketch

KEYS = st.one_of(st.none(), st.integers(0, 4))
SIDE = st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=25)


def frame(spark, rows, name):
    return spark.createDataFrame(rows, f"k INT, {name} INT")


def brute(a, b, how, null_safe):
    def same(x, y):
        return x == y if null_safe else x is not None and x == y

    out = Counter((l[0], l[1], r[1]) for l in a for r in b if same(l[0], r[0]))
    if how in ("left", "outer"):
        out.update((l[0], l[1], None) for l in a if not any(same(l[0], r[0]) for r in b))
    if how in ("right", "outer"):
        out.update((r[0], None, r[1]) for r in b if not any(same(l[0], r[0]) for l in a))
    return out


@pytest.mark.parametrize("how", ["left", "inner", "right", "outer"])
@pytest.mark.parametrize("null_safe", [False, True])
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=SIDE, b=SIDE)
def test_salted_join_matches_brute_force(spark, how, null_safe, a, b):
    got = joins.key_join(frame(spark, a, "x"), frame(spark, b, "y"), "k", how, null_safe, pairs_together=3)
    assert Counter(tuple(r) for r in got.select("k", "x", "y").collect()) == brute(a, b, how, null_safe)


@pytest.mark.parametrize("how", ["left", "right", "outer"])
def test_hot_key_with_copies_keeps_every_row(spark, how):
    a = [(1, i % 2) for i in range(60)] + [(2, 0), (None, 5), (None, 6), (9, 9)]
    b = [(1, 0)] * 50 + [(1, 1)] * 10 + [(3, 3), (None, 1)]
    left, right = frame(spark, a, "x"), frame(spark, b, "y")
    got = joins.key_join(left, right, "k", how, pairs_together=100)
    assert Counter(tuple(r) for r in got.collect()) == brute(a, b, how, False)


def test_hot_keys_follow_the_pairs(spark):
    left = spark.createDataFrame([(1, 4000), (2, 10), (3, 1), (4, 500), (None, 900)], "k INT, rows LONG")
    right = spark.createDataFrame([(1, 4000), (2, 10), (3, 10**9), (None, 7)], "k INT, rows LONG")
    hot = joins.hot_keys(left, right, "k", pairs_together=100)
    got = {(r._hot, r._n_left > 0): (r._salts_left, r._salts_right) for r in hot.collect()}
    assert got == {
        (1, True): (400, 400), (3, True): (1, 10**7), (4, True): (5, 1), (None, True): (9, 1),
    }
    assert joins.hot_keys(left, right, "k", pairs_together=10**10) is None
    assert joins.hot_keys(left, right, "k", pairs_together=100, max_hot=2).count() == 2
    one = joins.hot_keys(left, right, "k", null_safe=True, pairs_together=1000).where("_hot IS NULL").first()
    assert (one._n_left, one._n_right) == (900, 7)


def test_hot_join_leaves_several_tasks(spark):
    rows = [(1, i) for i in range(400)]
    got = joins.key_join(frame(spark, rows, "x"), frame(spark, rows, "y"), "k", "left", pairs_together=2000)
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 160_000 and len(tasks) > 1


@pytest.mark.parametrize("how", ["left", "outer"])
def test_salted_join_changes_no_value(spark, how):
    left = spark.createDataFrame(
        [(1, -0.0, {"a": 1}), (1, 0.0, {"a": 1}), (1, float("nan"), None), (2, -0.0, {}), (None, 1.0, None)],
        "k INT, x DOUBLE, m MAP<STRING, INT>",
    )
    right = spark.createDataFrame([(1, -0.0, {"b": 2}), (1, -0.0, {"b": 2}), (3, 0.0, {})], "k INT, y DOUBLE, n MAP<STRING, INT>")
    rows = [
        Counter(repr(tuple(r)) for r in joins.key_join(left, right, "k", how, pairs_together=p).collect())
        for p in (1, 10**9)
    ]
    assert rows[0] == rows[1] and sum(rows[0].values()) == (8 if how == "left" else 9)


def test_join_tables_suffixes(spark):
    a = spark.createDataFrame([(1, "a", 1)], "reco_id_curr INT, name STRING, p INT")
    b = spark.createDataFrame([(1, "b", 2), (2, "c", 3)], "reco_id_curr INT, name STRING, q INT")
    got = joins.join_tables(a, b, how="outer")
    assert got.columns == ["reco_id_curr", "name_1", "p", "name_2", "q"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1, "b", 2), (2, None, None, "c", 3)]
    with pytest.raises(ValueError):
        joins.join_tables(a, b, how="cross")


def test_unique_check(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k INT")
    with pytest.raises(ValueError, match="not unique"):
        joins.assert_unique(df, "k")
    assert joins.assert_unique(df.distinct(), "k").count() == 2
    with pytest.raises(Exception, match="key k is not unique.*2"):
        joins.enforced_unique(df, "k").collect()
    assert sorted(r.k for r in joins.enforced_unique(df.distinct(), "k").collect()) == [1, 2]


def test_sketches_find_heavy_keys(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(200_000),) for _ in range(100_000)] + [(7,)] * 900 + [(None,)] * 500
    df = spark.createDataFrame(rows, "k INT")
    made = key_sketch.sketches({"a": (df, "k"), "b": (df.selectExpr("cast(k as bigint) as k"), "k")})
    for sketch in made.values():
        assert sketch.most.sum() == len(rows)
        heavy = {i: sketch.heavy[i] for i in sketch.heavy.nonzero()[0]}
        assert len(heavy) == 2 and heavy.pop(key_sketch.BUCKETS) == 500
        (bucket,) = heavy
        assert 880 < heavy[bucket] <= 920
    one = key_sketch.KeySketch.of_unique()
    assert key_sketch.crowded_buckets(made["a"], one, 800) == [bucket]
    assert key_sketch.crowded_buckets(one, made["b"], 450) == [bucket, key_sketch.BUCKETS]
    assert key_sketch.crowded_buckets(made["a"], made["b"], 10**6) == []
    assert key_sketch.crowded_buckets(made["a"], made["b"], 10**5, null_safe=True) == [bucket, key_sketch.BUCKETS]
    twice = made["a"].joined(made["b"])
    assert twice.heavy[bucket] > 700_000 and twice.heavy[key_sketch.BUCKETS] == 500
    assert key_sketch.sketches({"e": (df.limit(0), "k")})["e"].most.sum() == 0


def test_a_hot_key_among_many_is_spread(spark):
    a = [(i, 0) for i in range(2000)] + [(5, i) for i in range(300)]
    b = [(i, 1) for i in range(0, 2000, 3)] + [(5, i) for i in range(200)]
    left, right = frame(spark, a, "x"), frame(spark, b, "y")
    got = joins.key_join(left, right, "k", "outer", pairs_together=5000)
    assert Counter(tuple(r) for r in got.collect()) == brute(a, b, "outer", False)
    tasks = got.where("k = 5").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1


@pytest.mark.parametrize("how", ["left", "inner", "right", "outer"])
def test_join_stats_match_the_join(spark, how):
    a = [(1, 0), (1, 1), (2, 0), (None, 0)]
    b = [(1, 0), (1, 1), (1, 2), (3, 0), (None, 1), (None, 2)]
    left, right = frame(spark, a, "x"), frame(spark, b, "y")
    joined = joins.key_join(left, right, "k", how)
    row = joins.join_stats(left, right, "k", how).first()
    assert row.rows_joined == joined.count()
    assert row.unique_keys_joined == joined.where("k is not null").select("k").distinct().count()
    assert (row.unique_keys_1, row.unique_keys_2, row.rows_1) == (2, 2, 4)
