"""Skewed inputs and forced large-table paths against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from chorus.operators import scale


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'hot' holds over a third of the rows."""
    rng = random.Random(7)
    rows = [("hot" if i % 5 < 2 else f"k{rng.randrange(60)}", i, rng.randrange(50)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, i int, v int").repartition(6)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("load", [None, "n"])
@pytest.mark.parametrize("limit", [None, 200])
def test_lookup_equals_plain_join(spark, skewed, how, load, limit):
    rows, frame = skewed
    counts = {}
    for k, _, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    known = {k: n for k, n in counts.items() if k == "hot" or int(k[1:]) % 3}
    table = spark.createDataFrame([(k, k.upper(), n) for k, n in known.items()], "k string, big string, n int")
    got = scale.lookup(frame, table, ["k"], load=load, how=how, limit=limit, hot_keys=3)
    assert set(got.columns) == {"k", "i", "v", "big", "n"}
    want = [(k, i, v, k.upper() if k in known else None, known.get(k)) for k, i, v in rows]
    if how == "inner":
        want = [r for r in want if r[3] is not None]
    assert sorted(map(tuple, got.select("k", "i", "v", "big", "n").collect()), key=repr) == sorted(want, key=repr)


def test_lookup_keeps_the_hot_key_out_of_the_shuffle(spark, skewed):
    rows, frame = skewed
    table = frame.groupBy("k").agg(F.count("*").alias("n"))
    got = scale.lookup(frame, scale.pin(table, "t"), ["k"], load="n", limit=200, hot_keys=3)
    assert got.count() == len(rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_lookup_with_hot_unknown_key(spark, skewed):
    rows, frame = skewed
    table = spark.createDataFrame([("k1", 1)], "k string, n int")
    got = scale.lookup(frame, table, ["k"], how="left", limit=0, hot_keys=3)
    assert got.count() == len(rows)
    assert got.filter("n is not null").count() == sum(k == "k1" for k, _, _ in rows)


@pytest.mark.parametrize("n", [1, 7, 2000])
def test_top_n(skewed, n):
    rows, frame = skewed
    got = scale.top_n(frame, ["k"], [F.col("v").desc(), F.col("i").asc()], n)
    want = set()
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1]))[:n]
        want |= {(*r, at + 1) for at, r in enumerate(group)}
    assert {tuple(r) for r in got.select("k", "i", "v", "rank").collect()} == want


def test_top_n_prunes_before_each_shuffle(skewed):
    _, frame = skewed
    plan = scale.top_n(frame, ["k"], [F.col("v").desc()], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number(), 5, Partial") == 2


def test_rank_all(skewed):
    rows, frame = skewed
    got = scale.rank_all(frame, ["k"], [F.col("v").desc(), F.col("i").asc()])
    assert got.columns == ["k", "i", "v", "rank"]
    want = set()
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1]))
        want |= {(*r, at + 1) for at, r in enumerate(group)}
    assert {tuple(r) for r in got.collect()} == want


def test_first_copy(skewed):
    rows, frame = skewed
    got = {tuple(r) for r in scale.first_copy(frame, ["k"], [F.col("i")]).collect()}
    assert got == {min((r for r in rows if r[0] == k), key=lambda r: r[1]) for k in {r[0] for r in rows}}


def test_null_keys_match_each_other(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([(None,), ("a",)], "k string")
    got = scale.match_null_safe(left, right, ["k"], "left_anti")
    assert [tuple(r) for r in got.collect()] == [("b", 3)]


def test_pin_by_key_prunes(spark, skewed):
    rows, frame = skewed
    kept = scale.pin(frame, "by_key", ["k"])
    one = kept.filter(F.col("k") == "k1")
    assert kept.columns == frame.columns and kept.count() == len(rows)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan
    assert one.count() == sum(k == "k1" for k, _, _ in rows)


def test_work_dir_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert scale.work_dir(spark).startswith(base.rstrip("/") if base else "/")


@pytest.mark.parametrize("nulls", [False, True])
def test_lookup_hashes_a_table_of_light_partitions(spark, skewed, monkeypatch, nulls):
    _, frame = skewed
    table = scale.pin(frame.groupBy("k").agg(F.count("*").alias("n")), "t")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {}
    for limit in (scale.HASHED_BYTES, 0):
        monkeypatch.setattr(scale, "HASHED_BYTES", limit)
        got = scale.lookup(frame, table, ["k"], load="n", limit=200, hot_keys=3, nulls=nulls)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("ShuffledHashJoin" in plan, "SortMergeJoin" in plan) == (limit > 0, limit == 0)
        found[limit] = sorted(map(tuple, got.select("k", "i", "v", "n").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == 2 and found[0] == found[max(found)]
