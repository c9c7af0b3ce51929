"""Streams against batch reads of the same files."""

import json

from stintlake.sources.readers import read_entity
from stintlake.sources.writers import read_table
from stintlake.streaming.expectations import (
    expect_drop,
    expect_track,
    laps_quality,
    locations_quality,
)
from stintlake.streaming.ingest import (
    append_stream,
    chain_stream,
    evolving_stream,
    max_files,
    stream_entity,
)

COLS = ["session_key", "driver_number", "lap_number", "lap_duration"]


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(records))


def lap(s, d, n, t, **more):
    return {"session_key": s, "driver_number": d, "lap_number": n, "lap_duration": t, **more}


def test_stream_equals_batch_and_restarts(spark, tmp_path, rows):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(landing, "laps_1.json", [lap(1, 7, 1, 90.0), lap(1, 7, 2, None)])
    land(landing, "laps_2.json", [lap(1, 8, 1, 95.0)])
    land(landing, "drivers_1.json", [{"session_key": 1}])

    def run():
        append_stream(stream_entity(spark, str(landing), "laps", 1), out, state).awaitTermination()
        return spark.read.parquet(out)

    assert rows(run(), *COLS) == rows(read_entity(spark, str(landing), "laps"), *COLS)
    assert run().count() == 3  # nothing is read twice
    land(landing, "laps_3.json", [lap(2, 7, 1, 70.0)])
    got = run()
    assert rows(got, *COLS) == rows(read_entity(spark, str(landing), "laps"), *COLS)
    assert {"_source_file", "_ingestion_timestamp", "date_start_ts"} <= set(got.columns)


def test_files_per_trigger(spark, tmp_path):
    landing = tmp_path / "in"
    for i in range(5):
        land(landing, f"laps_{i}.json", [lap(1, 7, i, 90.0)])
    q = append_stream(stream_entity(spark, str(landing), "laps", 2), str(tmp_path / "o"), str(tmp_path / "s"))
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2, 1]
    assert max_files("locations") == 10


def test_expectations_drop_and_track(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "laps_1.json", [lap(1, 7, 1, 90.0), lap(None, 7, 2, 90.0), lap(1, None, 2, -1.0),
                                  lap(1, 7, 3, -5.0), lap(1, 7, 4, None)])
    raw, good = str(tmp_path / "raw"), str(tmp_path / "good")
    append_stream(stream_entity(spark, str(landing), "laps"), raw, str(tmp_path / "s1")).awaitTermination()
    q = append_stream(laps_quality(chain_stream(spark, raw)), good, str(tmp_path / "s2"))
    q.awaitTermination()
    assert sorted(r.lap_number for r in spark.read.parquet(good).collect()) == [1, 3, 4]
    seen = [p["observedMetrics"]["expectations"] for p in q.recentProgress if p["numInputRows"]]
    total = [sum(m[i] for m in map(lambda m: list(m.asDict().values()) if hasattr(m, "asDict") else list(m.values()), seen)) for i in range(4)]
    assert total == [5, 1, 1, 2]


def test_expectations_in_batch(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (1, None)], "x int, y int")
    assert locations_quality(df).count() == 1
    assert expect_drop(df, "x", "x IS NOT NULL").count() == 2
    assert expect_drop(df, "x", "x > 0").count() == 2  # NULL does not meet it
    assert expect_track(df, "x_known", "x IS NOT NULL").count() == 3


def test_evolving_stream(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(landing, "laps_1.json", [lap(1, 7, 1, 90)])

    def run():
        evolving_stream(spark, str(landing), "laps", out, state, 1).awaitTermination()
        return read_table(spark, out, evolving=True)

    assert run().count() == 1
    land(landing, "laps_2.json", [lap(1, 7, 2, 90.5, weather="dry", tyre={"set": 3})])
    land(landing, "laps_3.json", lap(1, 7, 3, 91.5, weather=12))
    got = sorted((r.lap_number, r.lap_duration, r.weather, r.tyre) for r in run().collect())
    assert got == [(1, 90.0, None, None), (2, 90.5, "dry", '{"set":3}'), (3, 91.5, "12", None)]
    assert run().count() == 3
    land(landing, "laps_4.json", [lap("n/a", 7, 4, 70.0), lap(1, 7, 5, {"s": 3})])
    got = {r.lap_number: (r.session_key, r.lap_duration, r._rescued) for r in run().collect()}
    assert got[4] == (None, 70.0, '{"session_key":"n/a"}')
    assert got[5][:2] == (1, None) and got[5][2].startswith('{"lap_duration":"{') and got[1][2] is None
    assert run().count() == 5


def test_interval_trigger(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "locations_1.json", [{"session_key": 1, "driver_number": 7, "x": 1, "y": 2}])
    out = str(tmp_path / "o")
    q = append_stream(stream_entity(spark, str(landing), "locations"), out, str(tmp_path / "s"), "1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == 1
