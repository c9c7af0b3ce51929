"""The stream of chunk counts against the batch reading of the same points."""

import pytest

from stintlake.operators.chunks import chunk_coverage, coverage_of_counts
from stintlake.streaming import coverage as V

POINTS = "session_key long, driver_number long, date string"


@pytest.fixture(scope="module")
def sessions(spark):
    # The second begins apart from full quarters of an hour, the third has no time.
    return spark.createDataFrame(
        [(1, "2024-03-02T10:00:00+00:00"), (2, "2024-03-02T16:07:31+00:00"), (3, None)],
        "session_key long, date_start string",
    )


def at(*times, s=1, d=7):
    return [(s, d, f"2024-03-02T{t}+00:00") for t in times]


@pytest.fixture
def streamed(spark, sessions, tmp_path):
    """Land rows and run the stream to the end of what is there."""
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run(rows=None, by=("driver_number",), **options):
        if rows is not None:
            spark.createDataFrame(rows, POINTS).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(POINTS).parquet(landing)
        query = V.chunk_count_stream(
            stream, sessions, target, str(tmp_path / "state"), by=by, **options
        )
        if options.get("every"):
            query.processAllAvailable()
            query.stop()
        else:
            query.awaitTermination()
        return spark.read.parquet(landing), V.streamed_counts(spark, target, by)

    return run


FIRST = [
    *at("09:30:00", "09:44:59", "09:45:00", "10:20:00", "10:20:00"), *at("09:00:00", d=8), *at("10:00:00", d=None),
    (1, 7, None), (9, 7, "2024-03-02T10:00:00+00:00"), (3, 7, "2024-03-02T10:00:00+00:00"),
]
SECOND = [*at("15:37:30", "15:37:31", "15:52:30", "15:52:31", "18:37:31", s=2), *at("10:21:00", d=8)]


@pytest.mark.parametrize("by", [("driver_number",), ()])
def test_equals_the_batch(sessions, streamed, rows, by):
    streamed(FIRST, by, delay="12 hours")
    points, counts = streamed(SECOND, by, delay="12 hours")
    assert rows(coverage_of_counts(sessions, counts, by)) == rows(chunk_coverage(sessions, points, by))


def test_late_points_are_dropped_and_counted(sessions, streamed, rows):
    streamed(FIRST)
    streamed(SECOND)  # in one batch, so 10:21 is not late yet
    points, counts = streamed([*at("10:20:30", "18:30:00", d=8), *at("18:00:00", s=2)])
    assert rows(V.late_points(points, sessions, counts), "session_key", "driver_number", "arrived", "counted", "late") \
        == [(1, 7, 5, 5, 0), (1, 8, 4, 3, 1), (2, 7, 6, 6, 0), (3, 7, 1, 0, 1)]
    on_time = points.filter("date <> '2024-03-02T10:20:30+00:00' AND session_key < 3")
    assert rows(coverage_of_counts(sessions, counts)) == rows(chunk_coverage(sessions, on_time))


def test_restart_counts_nothing_twice_and_intervals(streamed, rows):
    _, first = streamed(FIRST, every="1 second")
    before = rows(first)
    _, again = streamed()
    assert rows(again) == before
    _, more = streamed(at("10:20:59"))  # an open window goes on after a restart
    assert {r[:3]: r[3] for r in rows(more)}[1, 7, 3] == {r[:3]: r[3] for r in before}[1, 7, 3] + 1
