"""Histories of rows that arrive in any order against histories of all rows at once."""

import itertools

import pytest

from stintlake.operators.scd import scd2_from_history
from stintlake.sources import histories as H
from stintlake.sources.writers import current_parts

SCHEMA = "k long, t timestamp, team string, colour string, id long"
ROWS = [
    (1, "2024-01-01", "a", "x", 1), (1, "2024-01-05", "a", "x", 2), (1, "2024-01-03", "b", "x", 3),  # divides a
    (1, "2024-01-07", "b", None, 4), (1, "2024-01-06", "b", None, 5), (1, "2024-01-08", "a", "x", 6),
    (2, "2024-01-02", "c", "y", 7), (2, "2024-01-01", "c", "y", 8), (2, "2024-01-02", "d", "y", 9),  # one time twice
    (3, None, "e", "z", 10), (None, "2024-01-01", "e", "z", 11), (4, "2024-01-04", None, None, 12),
]
TRACKED = ["team", "colour"]


def frame(spark, rows):
    made = spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string"))
    return made.withColumn("t", made.t.cast("timestamp"))


def insert(spark, path, rows):
    return H.insert_history(path, frame(spark, rows), "k", TRACKED, "t", ["id"], buckets=4)


@pytest.fixture(scope="module")
def expected(spark):
    df = scd2_from_history(frame(spark, ROWS), "k", TRACKED, "t", ["id"])
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[1::2])
def test_any_order_of_loads(spark, tmp_path, rows, expected, order):
    for i in order:
        insert(spark, str(tmp_path), ROWS[i::3])
    assert rows(H.read_history(spark, str(tmp_path))) == expected


def test_stopped_and_repeated_loads(spark, tmp_path, rows, expected, monkeypatch):
    path = str(tmp_path)
    insert(spark, path, ROWS[6:])
    with monkeypatch.context() as m:
        def stopping(*args):
            raise InterruptedError
        m.setattr(H, "scd2_from_history", stopping)
        with pytest.raises(InterruptedError):
            insert(spark, path, ROWS[:6])
    insert(spark, path, ROWS[:6])
    insert(spark, path, ROWS[:6])
    assert rows(H.read_history(spark, path)) == expected


def test_other_buckets_stay_and_empty_loads(spark, tmp_path, rows):
    path = str(tmp_path)
    assert insert(spark, path, []) == [] and H.read_history(spark, path).count() == 0
    insert(spark, path, [(k, "2024-01-01", "a", "x", 1) for k in range(40)])
    before = dict(current_parts(spark, f"{path}/versions"))
    touched = insert(spark, path, [(5, "2023-12-31", "b", "x", 2)])
    after = dict(current_parts(spark, f"{path}/versions"))
    assert {label for label in after if after[label] != before[label]} == {f"4/{b}" for b in touched}
    assert len(touched) == 1 and len(after) == 4
    got = H.read_history(spark, path)
    assert got.count() == 41 and [r.team for r in got.filter("k = 5").orderBy("valid_from").collect()] == ["b", "a"]
