"""Checks on rows that break them."""

import pytest
from pyspark.sql import functions as F

from stintlake.operators import profile as P
from stintlake.operators import quality as Q
from stintlake.plans import checks


def counts(df):
    return {r.check_name: (r.violations, r.status) for r in df.collect()}


def test_row_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0, True), (1, None, -1.0, True), (2, "z", None, False), (None, "a", 3.0, None)],
        "k int, v string, n double, f boolean",
    )
    parent = spark.createDataFrame([(1,)], "id int")
    listed = {"t": [
        Q.not_null("k"), Q.unique("k", "k"), Q.accepted("v", ["a", "b"]), Q.accepted("v", ["a"], "warn"),
        Q.accepted("f", [True, False]), Q.relationship("k", "p", "id"),
        Q.expression("n_positive", "n > 0"), Q.expression("n_where", "n > 4", "f"),
        Q.implies("if_f", "f", "n > 0"),
    ]}
    got = counts(Q.run_checks({"t": df, "p": parent}, listed))
    assert got["not_null_k"] == (1, "fail")
    assert got["unique_k"] == (1, "fail")
    assert got["accepted_values_v"] == (1, "warn")
    assert got["accepted_values_f"] == (0, "pass")
    assert got["relationships_k"] == (1, "fail")
    assert got["n_positive"] == (1, "fail")  # NULL passes
    assert got["n_where"] == (1, "fail")
    assert got["if_f"] == (1, "fail")


def test_number_of_declared_checks():
    sizes = {n: sum(len(c) for c in d.values()) for n, d in {
        "bronze": checks.BRONZE_CHECKS, "silver": checks.SILVER_CHECKS,
        "core": checks.CORE_CHECKS, "marts": checks.MART_CHECKS}.items()}
    assert sizes == {"bronze": 12, "silver": 37, "core": 33, "marts": 31}


def test_value_checks(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (-1.0,), (29.9,), (30.0,), (300.5,), (None,)], "v double")
    assert {tuple(r) for r in Q.positive_values(df, "v").collect()} == {(0.0, 1), (-1.0, 2)}
    assert {r.lap_time for r in Q.reasonable_lap_time(df, "v").collect()} == {0.0, -1.0, 29.9, 300.5}
    assert {r.percentage_value for r in Q.valid_percentage(df, "v").collect()} == {-1.0, 300.5}
    times = spark.range(1).select(F.expr("current_timestamp() + interval 1 day").alias("t"))
    assert Q.no_future_dates(times, "t").first().violation_count == 1
    done = {r.column_name: r.completeness for r in Q.completeness(df, ["v"]).collect()}
    assert done == {"v": round(6 / 7, 6)}


@pytest.fixture(scope="module")
def board(spark):
    return spark.createDataFrame([(1, 1), (1, 2), (1, 4), (2, 1), (2, 1), (2, 2), (3, 2)], "session_key int, position int")


def test_positions(board, rows):
    gaps = checks.position_gaps(board)
    assert rows(gaps, "session_key", "actual_position", "expected_position") == [
        (1, 4, 3), (2, 1, 2), (2, 2, 3), (3, 2, 1)]
    steps = checks.position_steps(board)
    assert rows(steps, "session_key", "position") == [(1, 4), (2, 1), (3, 2)]


def test_cross_table_checks(spark, rows):
    laps = spark.createDataFrame(
        [(1, 7, 90.0, True), (1, 7, 400.0, False), (1, 8, 95.0, True), (9, 7, 80.0, True)],
        "session_key int, driver_number int, lap_duration double, is_valid_lap boolean")
    drivers = spark.createDataFrame([(1, 7, "Ferrari"), (1, 9, "Ferrari"), (9, 7, "RB")],
                                    "session_key int, driver_number int, team_category string")
    sessions = spark.createDataFrame([(1,)], "session_key int")
    assert rows(checks.orphaned_laps(laps, drivers, sessions)) == [
        (1, 8, "Missing driver record"), (9, 7, "Missing session record")]
    summary = spark.createDataFrame([(1, 7, 2, 2), (1, 8, 1, 1)],
                                    "session_key int, driver_number int, total_laps int, valid_laps int")
    bad = checks.summary_mismatches(summary, laps).collect()
    assert [(r.driver_number, r.summary_valid, r.actual_valid_laps) for r in bad] == [(7, 2, 1)]
    board = spark.createDataFrame([(1, 1, 90.02), (9, 1, 80.005)], "session_key int, position int, fastest_lap_time double")
    dim = spark.createDataFrame([(1,), (9,)], "session_key int")
    bad = checks.fastest_lap_mismatches(board, laps, dim).collect()
    assert [r.session_key for r in bad] == [1]
    teams = spark.createDataFrame([(1, "Ferrari", 1), (9, "RB", 1)], "session_key int, team_name string, drivers_count int")
    bad = checks.team_count_mismatches(teams, drivers).collect()
    assert [(r.team_name, r.reported_count, r.actual_count, r.difference) for r in bad] == [("Ferrari", 1, 2, -1)]
    dims = spark.createDataFrame([(1, True), (1, True), (2, False), (3, True)], "driver_number int, is_current boolean")
    assert rows(checks.not_one_current(dims)) == [(1, 2), (2, 0)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", None), (2, "a", 3.0), (None, None, 5.0)], "k int, v string, n double")
    for first in (False, True):
        r = P.profile(df, distinct={"ks": "k", "vs": "v"}, nulls={"no_n": "n"}, sums={"total": F.col("n")},
                      lows={"lo": "n"}, highs={"hi": "n"}, reduce_first=first).first()
        assert (r.total_records, r.ks, r.vs, r.no_n, r.total, r.lo, r.hi) == (4, 2, 2, 1, 9.0, 1.0, 5.0)
    empty = P.profile(df.limit(0), distinct={"ks": "k"}, nulls={"no_n": "n"}).first()
    assert (empty.total_records, empty.ks, empty.no_n) == (0, 0, 0)
    by = {r.k: r.vs for r in P.profile(df, by=["k"], distinct={"vs": "v"}).collect()}
    assert by == {1: 2, 2: 1, None: 0}


def test_distinct_counts_do_not_multiply_rows(spark, tmp_path):
    """The input is reduced before Spark repeats rows per distinct column."""
    path = str(tmp_path / "t")
    spark.range(100).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b")).write.parquet(path)
    plan = P.profile(spark.read.parquet(path), distinct={"x": "a", "y": "b"}, reduce_first=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("HashAggregate") < plan.index("FileScan")


def test_layer_reports(spark):
    def n(name, v):
        return spark.createDataFrame([(v,)], f"{name} long")

    r = P.preservation("entity", "laps", n("b", 200), n("s", 199), ("b", "s")).first()
    assert (r.entity, r.difference, r.preservation_pct) == ("laps", -1, 99.5)
    assert P.preservation("entity", "x", n("b", 0), n("s", 0), ("b", "s")).first().preservation_pct is None
    fresh = P.freshness({"t": spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS _ingestion_timestamp")})
    assert tuple(P.stale(fresh, "2024-01-03 00:59:00", 48).first()) == ("t", 48, False)
    assert tuple(P.stale(fresh, "2024-01-03 01:00:00", 48).first()) == ("t", 49, True)
    counts = P.count_rows({"a": spark.range(3), "b": spark.range(30)})
    got = {r.table_name: r.in_range for r in P.count_in_range(counts, {"a": (3, 5), "b": (1, 29)}).collect()}
    assert got == {"a": True, "b": False}
