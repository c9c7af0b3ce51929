"""Sliced and plain windows must give the same rows: every operator runs both ways."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stintlake.operators.dedupe import duplicate_keys, latest_per_key
from stintlake.operators.grouping import (
    ranks,
    row_numbers,
    running_sums,
    with_group_value,
    with_previous,
)


def skewed(spark, n=600):
    """A third of the rows in one group, many of them copies, and a NULL key."""
    rng = random.Random(7)
    data = []
    for i in range(n):
        key = 1 if i % 3 == 0 else rng.choice([None, 2, 3, 4, 5, 6, 7, 8])
        data.append((key, rng.choice([None, 1.0, 1.5, 2.0, 9.25]), i // 4))
    return spark.createDataFrame(data, "k int, v double, id int")


def order():
    return [F.col("v").asc_nulls_first(), F.col("id")]


@pytest.mark.parametrize("slices", [
    None, "floor(v)", ["floor(v)", "struct(v, floor(id / 10))"], ["isnotnull(v)", "floor(v)", "v", "id"],
])
def test_row_numbers(spark, slices):
    by = [F.expr(x) for x in slices] if isinstance(slices, list) else slices and F.expr(slices)
    got = row_numbers(skewed(spark), ["k"], order(), "n", by).collect()
    want = {}
    for r in skewed(spark).collect():
        want.setdefault(r.k, []).append((r.v is not None, r.v or 0.0, r.id))
    seen = {}
    for r in got:
        seen.setdefault(r.k, []).append((r.n, (r.v is not None, r.v or 0.0, r.id)))
    assert set(seen) == set(want)
    for k, items in seen.items():
        items.sort()
        assert [n for n, _ in items] == list(range(1, len(items) + 1))
        assert [v for _, v in items] == sorted(want[k])


def test_copies_of_one_row(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    got = row_numbers(df, ["k"], [F.col("v")], "n", F.length("v"))
    assert sorted(r.n for r in got.collect()) == list(range(1, 501))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9)), min_size=1, max_size=40))
def test_running_sums(spark, pairs):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(pairs)], "k int, v long, id int")
    levels = [F.floor(F.col("v") / 5), F.floor(F.col("v") / 3), F.col("v")]
    got = running_sums(df, ["k"], [F.col("v"), F.col("id")], {"s": F.col("v")}, levels)
    want, totals = {}, {}
    for k, v, i in sorted((k, v, i) for i, (k, v) in enumerate(pairs)):
        totals[k] = totals.get(k, 0) + v
        want[i] = totals[k]
    assert {r.id: r.s for r in got.collect()} == want


@pytest.mark.parametrize("ties", ["row_number", "rank", "dense_rank"])
@pytest.mark.parametrize("nulls", ["first", "last"])
def test_ranks(spark, ties, nulls, rows):
    df = skewed(spark).distinct()
    got = ranks(df, ["k"], "v", ties, ["id"], nulls, "r")
    by_sql = {"row_number": "row_number()", "rank": "rank()", "dense_rank": "dense_rank()"}[ties]
    more = ", id" if ties == "row_number" else ""
    want = df.selectExpr(
        "k", "v", "id",
        f"{by_sql} over (partition by k order by v nulls {nulls}{more}) as r",
    )
    assert rows(got, "k", "v", "id", "r") == rows(want)


@pytest.mark.parametrize("descending", [False, True])
def test_with_previous(spark, rows, descending):
    df = skewed(spark).dropDuplicates(["k", "v", "id"])
    sign = -1 if descending else 1
    # NULL is lowest: it comes first going up, and last going down.
    slices = [F.coalesce(F.floor("v"), F.lit(-1)) * sign, F.coalesce("v", F.lit(-1)) * sign, F.floor(F.col("id") / 5) * sign]
    plain = with_previous(df, ["k"], ["v", "id"], {"before": "id"}, None, descending)
    sliced = with_previous(df, ["k"], ["v", "id"], {"before": "id"}, slices, descending)
    how = "v desc nulls last, id desc" if descending else "v nulls first, id"
    want = df.selectExpr("k", "v", "id", f"lag(id) over (partition by k order by {how}) as before")
    assert rows(plain, "k", "v", "id", "before") == rows(want)
    assert rows(sliced, "k", "v", "id", "before") == rows(want)


def test_group_value_keeps_every_row(spark, rows):
    df = skewed(spark)
    got = with_group_value(df, ["k"], F.min("v"), "low")
    want = df.selectExpr("k", "v", "id", "min(v) over (partition by k) as low")
    assert rows(got, "k", "v", "id", "low") == rows(want)


def test_latest_per_key(spark):
    data = [(1, "2024-01-01", "b"), (1, "2024-01-02", "z"), (1, "2024-01-02", "a"), (2, None, "q")]
    df = spark.createDataFrame(data, "k int, t string, v string")
    got = latest_per_key(df, ["k"], [F.col("t").desc_nulls_last()], ["v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one row per key leaves each map task
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "q")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1), (None, 1)], "a int, b int")
    got = {r.a: r.duplicate_count for r in duplicate_keys(df, ["a"]).collect()}
    assert got == {1: 2, None: 2}


def test_no_slice_is_large(spark):
    """Half of all rows in one session and a third in one lap time: windows stay small.

    The finest slices and the slices within a coarser one are what a window covers.
    """
    df = spark.range(30_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 97).alias("k"),
        F.when(F.col("id") % 3 == 0, 90.0).otherwise(60 + F.col("id") * 7919 % 30_000 / 1000).alias("v"),
        (F.col("id") % 500).alias("driver"),
    )
    levels = df.select("k", F.floor("v").alias("a"), F.struct("v", "driver").alias("b"))
    finest = levels.groupBy("k", "a", "b").count()
    inner = finest.groupBy("k", "a").count()
    outer = inner.groupBy("k").count()
    assert max(x.agg(F.max("count")).first()[0] for x in (finest, inner, outer)) <= 1000
    got = ranks(df, ["k"], "v", "row_number", ["driver"], "first", "n")
    numbered = got.groupBy("k").agg(
        (F.max("n") == F.count("*")).alias("whole"), (F.count_distinct("n") == F.count("*")).alias("once")
    )
    assert numbered.filter("NOT whole OR NOT once").count() == 0
