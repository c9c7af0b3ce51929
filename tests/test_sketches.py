"""Distinct counts from sketches."""

from stintlake.operators.sketches import distinct_sketches, united_counts
from stintlake.sources import writers

MEASURES = {"a": ["a"], "pairs": ["a", "b"]}


def counts(df):
    return {r.measure: r.distinct_values for r in df.collect()}


def test_loads_are_united_not_added(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rows = spark.range(60_000).selectExpr("id % 20000 AS a", "id % 3 AS b", "id % 5 AS day")
    for name, part in (("one", rows.filter("a < 15000")), ("two", rows.filter("a >= 5000"))):
        writers.append_table(distinct_sketches(part, MEASURES, ["day"]), path, name)
        writers.append_table(distinct_sketches(part, MEASURES, ["day"]), path, name)
    got = counts(united_counts(writers.read_table(spark, path)))
    for measure, exact in {"a": 20_000, "pairs": 60_000}.items():
        assert abs(got[measure] - exact) <= 0.02 * exact
    day = counts(united_counts(writers.read_table(spark, path).filter("day = 1")))
    assert abs(day["a"] - rows.filter("day = 1").select("a").distinct().count()) <= 0.02 * 4_000


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2), (1, 2), (1, 2)], "a int, b int")
    assert counts(united_counts(distinct_sketches(df, MEASURES))) == {"a": 1, "pairs": 1}
    assert counts(united_counts(distinct_sketches(df.limit(0), MEASURES))) == {"a": 0, "pairs": 0}
    assert united_counts(distinct_sketches(df.limit(0), MEASURES, ["b"]), ["b"]).count() == 0
