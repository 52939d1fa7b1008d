"""Keyed joins give the same rows whichever way they run."""

from __future__ import annotations

from collections import Counter

import pytest

from creditloom.operators import keyed
from creditloom.operators.keyed import KeyedPolicy


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(600).selectExpr(
        "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 90 end as k",
        "id % 5 as copy",
    )
    right = spark.range(0, 120, 2).selectExpr("id + 1 as k", "id as fact")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [[], [7], [7, 8, 9], list(range(120))])
def test_join_one(spark, sides, how, hot):
    left, right = sides
    plain = left.join(right, "k", how).select("k", "copy", "fact")
    hot_df = spark.createDataFrame([(k, 1 + k % 5) for k in hot], "k bigint, _salts int")
    got = keyed.join_one(left, right, ["k"], how, hot_df if hot else None)
    assert rows(got.select("k", "copy", "fact")) == rows(plain)


def test_join_one_rejects_other_joins(sides):
    left, right = sides
    with pytest.raises(ValueError):
        keyed.join_one(left, right, ["k"], "full_outer")


def test_hot_keys(spark, sides):
    """Every key over the limit is dealt out, however many there are."""
    left, _ = sides
    assert keyed.hot_keys(left, ["k"], KeyedPolicy(hot_rows=1000)) is None
    hot = keyed.hot_keys(left, ["k"], KeyedPolicy(hot_rows=50))
    assert [(r.k, r._salts) for r in hot.collect()] == [(7, 6)]
    every = keyed.hot_keys(left, ["k"], KeyedPolicy(hot_rows=1))
    assert every.count() == left.filter("k is not null").select("k").distinct().count()


def test_hot_rows_are_dealt_over_tasks_and_joined_once(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = keyed.hot_keys(left, ["k"], KeyedPolicy(hot_rows=50))
        joined = keyed.join_one(left, right, ["k"], "inner", hot)
        plan = final_plan(joined)
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
        assert plan.count("Exchange hashpartitioning(k") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("check", [keyed.require_unique, keyed.require_unique_first])
@pytest.mark.parametrize("keys", [["k"], ["k", "l"]])
def test_require_unique(spark, keys, check):
    good = spark.createDataFrame([(1, 1), (2, 1)], "k int, l int")
    assert check(good, keys, "t").count() == 2
    assert check(good.filter("k > 9"), keys, "t").count() == 0
    twice = spark.createDataFrame([(1, 1), (2, 1), (1, 1)], "k int, l int")
    with pytest.raises(Exception, match="t: duplicate key"):
        check(twice, keys, "t").collect()
    null = spark.createDataFrame([(1, 1), (None, 1)], "k int, l int")
    with pytest.raises(Exception, match="t: null in key"):
        check(null, keys, "t").collect()


def test_first_check_moves_keys_only(spark):
    rows = spark.createDataFrame([(k, "x") for k in range(9)], "k int, wide string")
    plan = final_plan(keyed.require_unique_first(rows, ["k"], "t"))
    assert "Exchange hashpartitioning(k" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "wide" in line]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_unique_check_adds_no_shuffle_to_a_join(spark):
    """Broadcasts off, as with big tables: one exchange and sort per side, check included."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.createDataFrame([(k, k) for k in range(100)], "k bigint, a bigint")
        b = spark.createDataFrame([(k, k) for k in range(50, 150)], "k bigint, b bigint")
        checked = keyed.require_unique(a, ["k"], "a").join(
            keyed.require_unique(b, ["k"], "b"), "k", "full_outer"
        )
        for plan in (final_plan(checked), final_plan(a.join(b, "k", "full_outer"))):
            assert plan.count("Exchange hashpartitioning") == 2
            assert plan.count("Sort [") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
