"""Session selection and time chunks."""

import datetime as dt

import pytest

from stintlake.operators.chunks import chunk_coverage, chunk_plan, points_in_chunks
from stintlake.operators.sessions import race_sessions, select_sessions, stamp_children


@pytest.fixture(scope="module")
def sessions(spark):
    return spark.createDataFrame(
        [(1, "Race", "Race", "2024-03-02T15:00:00+00:00", 2024, "A B/C"),
         (2, "FP1", "Practice", "2024-03-01T10:00:00+00:00", 2024, None),
         (3, "Race", "Race", "2023-03-01T10:00:00+00:00", 2023, "X"),
         (4, None, "Race", None, 2024, "Y")],
        "session_key int, session_name string, session_type string, date_start string, year int, location string")


def keys(df):
    return [r.session_key for r in df.collect()]


def test_selection(spark, sessions):
    assert keys(select_sessions(sessions, "latest", 2)) == [1, 2]
    assert keys(select_sessions(sessions, "oldest", 2)) == [4, 3]  # a missing start sorts first
    assert sorted(keys(select_sessions(sessions, "year", year=2024))) == [1, 2, 4]
    assert keys(select_sessions(sessions, "manual", days=["2024-03-01"])) == [2]
    assert keys(race_sessions(sessions, 2024)) == [1, 4]
    more = spark.range(10, 160).selectExpr(
        "cast(id as int) AS session_key", "'FP' AS session_name", "'Practice' AS session_type",
        "'2024-12-01T10:00:00+00:00' AS date_start", "2024 AS year", "'Z' AS location",
    )
    assert keys(race_sessions(sessions.unionByName(more), 2024)) == [1, 4]
    with pytest.raises(ValueError):
        select_sessions(sessions, "some")


def test_stamp(spark, sessions):
    laps = spark.createDataFrame([(1, 7), (2, 7), (9, 7)], "session_key int, driver_number int")
    got = {r.session_key: r for r in stamp_children(laps, sessions).collect()}
    assert set(got) == {1, 2, 9}
    assert (got[9].batch_day, got[9].session_name) == ("unknown", "Unknown")
    assert got[9].file_key == "laps_unknown_Unknown_Unknown"
    twice = stamp_children(laps, sessions.unionByName(sessions))
    assert twice.count() == 3 and twice.columns[-1] == "file_key"
    assert (got[1].batch_day, got[1].session_name, got[1].file_key) == ("2024-03-02", "Race", "laps_2024-03-02_A_B_C_Race")
    assert got[2].file_key == "laps_2024-03-01_Unknown_FP1"


def test_plan(spark, sessions):
    plan = sorted((r.session_key, r.chunk, r.chunk_start, r.chunk_end) for r in chunk_plan(sessions).collect())
    assert len(plan) == 36
    assert plan[0] == (1, 0, dt.datetime(2024, 3, 2, 14, 30), dt.datetime(2024, 3, 2, 14, 45))
    assert plan[11][3] == dt.datetime(2024, 3, 2, 17, 30)


def points(spark, times):
    return spark.createDataFrame(
        [(1, 7, f"2024-03-02T{t}+00:00") for t in times], "session_key int, driver_number int, date string")


def test_edges(spark, sessions):
    p = points(spark, ["14:29:59", "14:30:00", "14:44:59.999", "14:45:00", "17:29:59", "17:30:00"])
    half = sorted(r.chunk for r in points_in_chunks(p, sessions).collect())
    assert half == [0, 0, 1, 11]
    assert sorted(r.chunk for r in points_in_chunks(p, sessions, edges="open").collect()) == [0, 11]


def test_coverage_and_stop(spark, sessions):
    p = points(spark, ["14:31:00", "14:32:00", "15:40:00", "17:01:00"])  # chunks 0, 0, 4, 10
    got = {r.chunk: (r.points, r.is_read) for r in chunk_coverage(sessions, p).collect()}
    assert len(got) == 12
    assert [got[c][0] for c in range(12)] == [2, 0, 0, 0, 1, 0, 0, 0, 0, 0, 1, 0]
    # Chunks 1 to 3 are empty, so the reader stops after chunk 3.
    assert [c for c in range(12) if got[c][1]] == [0, 1, 2, 3]
    later = {r.chunk: r.is_read for r in chunk_coverage(sessions, p, stop_after=4).collect()}
    assert [c for c in range(12) if later[c]] == list(range(9))
    by_session = chunk_coverage(sessions, p, by=())
    assert by_session.count() == 36
