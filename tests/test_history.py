"""Incremental loads, snapshots, change history, lookups and overlaps."""

import datetime as dt
import random

import pytest

from stintlake.operators.incremental import high_water_mark, incremental_read, merge_upsert
from stintlake.operators.scd import (
    asof_join,
    interval_order_errors,
    scd2_from_history,
    snapshot,
    version_overlaps,
)
from stintlake.sources.writers import append_new


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_high_water_mark(spark):
    source = spark.createDataFrame([(1, day(0)), (2, day(1)), (3, day(2))], "k int, t timestamp")
    empty = source.limit(0)
    assert high_water_mark(empty, "t") is None
    assert incremental_read(source, None, "t").count() == 3
    assert incremental_read(source, empty, "t").count() == 3
    later = incremental_read(source, source.filter("k = 2"), "t")
    assert [r.k for r in later.collect()] == [3]


def test_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, day(0)), (2, day(1))], "k int, t timestamp")
    df.write.parquet(path)
    plan = incremental_read(spark.read.parquet(path), df.filter("k = 1"), "t")
    assert "GreaterThan(t" in plan._jdf.queryExecution().executedPlan().toString()


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 1)], "k int, name string, cat string, t int")
    new = spark.createDataFrame([(2, None, "Y", 5), (3, "c", "z", 5)], "k int, name string, cat string, t int")
    part = merge_upsert(old, new, ["k"], ["name"], report=True)
    assert sorted(tuple(r) for r in part.collect()) == [
        (1, "a", "x", 1, "kept"), (2, None, "y", 1, "updated"), (3, "c", "z", 5, "inserted"),
    ]
    full = merge_upsert(old, new, ["k"], ["name"], update_all=True)
    assert sorted(tuple(r) for r in full.collect())[1] == (2, None, "Y", 5)
    assert merge_upsert(None, new, ["k"], ["name"]).count() == 2


def test_merge_unites_columns(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, name string, cat string")
    new = spark.createDataFrame([(2, "B", 7), (3, "c", 8)], "k int, name string, extra int")
    for update_all in (False, True):
        got = merge_upsert(old, new, ["k"], ["name"], update_all)
        assert got.columns == ["k", "name", "cat", "extra"]
        assert sorted(tuple(r) for r in got.collect()) == [
            (1, "a", "x", None), (2, "B", "y", 7), (3, "c", None, 8)
        ]


def test_updates_alone_do_not_move_the_mark(spark):
    """The partial merge keeps the old load time; ``update_all`` moves it."""
    cols = "k int, name string, t timestamp"
    old = spark.createDataFrame([(1, "a", day(0))], cols)
    new = spark.createDataFrame([(1, "b", day(5))], cols)
    assert high_water_mark(merge_upsert(old, new, ["k"], ["name"]), "t") == day(0)
    assert high_water_mark(merge_upsert(old, new, ["k"], ["name"], True), "t") == day(5)


def test_append_new(spark):
    old = spark.createDataFrame([(1, 1, day(0))], "a int, b int, t timestamp")
    new = spark.createDataFrame([(1, 1, day(1)), (2, 5, day(1)), (2, 6, day(2))], "a int, b int, t timestamp")
    assert append_new(old, new).count() == 3
    got = append_new(old, new, ["a"], ["t"]).collect()
    assert [(r.a, r.b) for r in got] == [(2, 6)]


def test_snapshot(spark):
    cols = "k int, name string, updated_at timestamp"

    def state(df):
        return sorted((r.k, r.name, r.valid_from, r.valid_to) for r in df.collect())

    first = snapshot(
        None, spark.createDataFrame([(1, "a", day(0)), (2, "b", day(0)), (2, "old", day(-1))], cols),
        "k", "updated_at", str(day(1)),
    )
    assert state(first) == [(1, "a", day(0), None), (2, "b", day(0), None)]
    source = spark.createDataFrame([(1, "a2", day(3)), (3, "c", day(3))], cols)
    second = snapshot(first, source, "k", "updated_at", str(day(4)))
    assert sorted(state(second), key=repr) == sorted([
        (1, "a", day(0), day(3)), (1, "a2", day(3), None), (2, "b", day(0), day(4)),
        (3, "c", day(3), None),
    ], key=repr)
    # The same source again changes nothing; a key that returns opens a new version.
    assert sorted(state(snapshot(second, source, "k", "updated_at", str(day(5)))), key=repr) == sorted(state(second), key=repr)
    back = source.unionByName(spark.createDataFrame([(2, "b2", day(6))], cols))
    third = snapshot(second, back, "k", "updated_at", str(day(7)))
    assert (2, "b2", day(6), None) in state(third) and len(state(third)) == 5
    kept = snapshot(first, source, "k", "updated_at", str(day(4)), hard_deletes=False)
    assert (2, "b", day(0), None) in state(kept)
    assert third.select("scd_id").distinct().count() == 5


def history(spark, n=200):
    rng = random.Random(3)
    data = [(1 if i % 3 == 0 else rng.randint(2, 5), rng.choice(["A", "A", "B", None]), day(rng.randint(0, 400)), i)
            for i in range(n)]
    return spark.createDataFrame(data, "k int, team string, t timestamp, id int")


def test_scd2_compares_columns(spark):
    rows = [(1, "A-B", "C", day(0)), (1, "A", "B-C", day(1)), (1, "A", "B-C", day(2)), (1, None, "B-C", day(3))]
    df = spark.createDataFrame(rows, "k int, team string, colour string, t timestamp")
    got = scd2_from_history(df, "k", ["team", "colour"], "t").orderBy("valid_from").collect()
    assert [(r.team, r.colour, r.valid_from) for r in got] == [
        ("A-B", "C", day(0)), ("A", "B-C", day(1)), (None, "B-C", day(3))
    ]


def test_scd2(spark):
    df = history(spark)
    got = scd2_from_history(df, "k", ["team"], "t", ["id"]).collect()
    last = {}
    for r in df.collect():
        if (r.k, r.t) not in last or last[r.k, r.t].id < r.id:
            last[r.k, r.t] = r
    want = []
    for k in {r.k for r in last.values()}:
        runs = []
        for r in sorted((r for r in last.values() if r.k == k), key=lambda r: r.t):
            if not runs or runs[-1][0] != r.team:
                runs.append((r.team, r.t))
        ends = [t for _, t in runs[1:]] + [None]
        want += [(k, team, t, e, e is None) for (team, t), e in zip(runs, ends)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_asof_join_equals_brute_force(spark):
    dim = scd2_from_history(history(spark), "k", ["team"], "t", ["id"])
    facts = spark.createDataFrame(
        [(i % 6 + 1, day(i * 3 % 500) + dt.timedelta(hours=i % 5), i) for i in range(150)],
        "k int, at timestamp, n int",
    )
    got = sorted((r.n, r.valid_from) for r in asof_join(facts, dim, "k", "at").collect())
    versions = dim.collect()
    want = sorted(
        (f.n, v.valid_from) for f in facts.collect() for v in versions
        if v.k == f.k and v.valid_from <= f["at"] and (v.valid_to is None or f["at"] <= v.valid_to)
    )
    assert got == want and want
    assert asof_join(facts.limit(0), dim, "k", "at").count() == 0


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(5)
    data = []
    for i in range(90):
        s = rng.randint(0, 60)
        data.append((1 if i % 3 else i % 7, day(s), None if i % 17 == 0 else day(s + rng.randint(1, 9)), i))
    data += [(1, day(3), day(8), 900), (1, day(3), day(8), 901), (50, day(1), day(2), 902), (50, day(2), day(3), 903)]
    df = spark.createDataFrame(data, "k int, valid_from timestamp, valid_to timestamp, id int")
    got = {(r.k, r.valid_from, r.valid_to): (r.versions, r.overlaps)
           for r in version_overlaps(df, "k", str(day(100))).collect()}
    spans = [(k, s, e or day(100), i) for k, s, e, i in data]
    want = {}
    for k, s, e, i in spans:
        n = sum(1 for k2, s2, e2, i2 in spans if k2 == k and i2 != i and s2 < e and e2 > s)
        if n:
            copies = sum(1 for x in spans if x[:3] == (k, s, e))
            want[k, s, e] = (copies, n)
    assert got == want


def test_interval_errors(spark):
    df = spark.createDataFrame(
        [(1, day(0), day(1), False), (1, day(1), None, True), (2, day(3), day(2), False), (3, day(0), day(1), True)],
        "k int, valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    got = sorted((r.k, r.issue) for r in interval_order_errors(df).collect())
    assert got == [(2, "valid_from >= valid_to for historical record"), (3, "Current record has non-NULL valid_to")]
