"""Models on hand-made rows with every edge case."""

import re

import pytest
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.plans import gold, marts, silver
from stintlake.sources.schemas import DDL

RUN = "2024-06-01 00:00:00"


def frame(spark, entity, records):
    names = [c.strip().split()[0] for c in DDL[entity].split(",")]
    schema = DDL[entity] + ", _ingestion_timestamp TIMESTAMP"
    stamp = F.lit("2024-01-01").cast("timestamp")
    data = [tuple(r.get(n) for n in names) + (None,) for r in records]
    df = spark.createDataFrame(data, schema)
    loads = [r.get("_load", "2024-01-01") for r in records]
    if len(set(loads)) > 1:
        parts = [
            spark.createDataFrame([d], schema).withColumn("_ingestion_timestamp", F.lit(t).cast("timestamp"))
            for d, t in zip(data, loads)
        ]
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p)
        return df
    return df.withColumn("_ingestion_timestamp", stamp)


def lap(s, d, n, t, **more):
    return {"session_key": s, "driver_number": d, "lap_number": n, "lap_duration": t,
            "batch_day": "2024-03-02", **more}


@pytest.fixture(scope="module")
def layers(spark):
    sessions = frame(spark, "sessions", [
        {"session_key": 1, "session_name": "Race", "date_start": "2024-03-02T15:00:00+00:00",
         "date_end": "2024-03-02T17:30:00+00:00", "year": 2024, "location": "Here"},
        {"session_key": 2, "session_name": None, "session_type": "Practice", "date_start": "junk",
         "date_end": "2024-03-02T17:30:00+00:00"},
        {"session_key": 1, "session_name": "Sprint", "_load": "2023-01-01"},
        {"session_key": None, "session_name": "Race"},
    ])
    drivers = frame(spark, "drivers", [
        {"session_key": 1, "driver_number": 7, "full_name": "Ann A", "team_name": "Ferrari"},
        {"session_key": 1, "driver_number": 8, "first_name": "Bob", "last_name": "B"},
        {"session_key": 1, "driver_number": 9, "broadcast_name": "C C", "team_name": "Visa RB"},
        {"session_key": 1, "driver_number": 10, "full_name": "Dee", "team_name": "Ferrari"},
        {"session_key": 1, "driver_number": None, "full_name": "Nobody"},
    ])
    laps = frame(spark, "laps", [
        lap(1, 7, 1, 95.5, is_pit_out_lap=True, duration_sector_1=30.0),
        lap(1, 7, 2, 90.0, duration_sector_1=30.0, duration_sector_2=30.0, duration_sector_3=29.0,
            i1_speed=200, i2_speed=None, st_speed=310),
        lap(1, 7, 3, 90.5, duration_sector_1=29.5, duration_sector_2=31.0, duration_sector_3=30.0),
        lap(1, 7, 4, 90.0, is_pit_out_lap=True),
        lap(1, 7, 5, None),
        lap(1, 8, 1, 300.001), lap(1, 8, 2, 9.999),
        lap(1, 9, 1, 90.0),
        lap(1, 10, 1, 10.0), lap(1, 10, 2, 300.0),
        lap(1, 99, 1, 80.0),
        lap(3, 7, 1, 70.0),
        lap(1, 7, None, 60.0), lap(1, None, 1, 60.0), lap(None, 7, 1, 60.0),
    ])
    ss = silver.build_silver_sessions(sessions, RUN)
    sd = silver.build_silver_drivers(drivers, RUN)
    sl = silver.build_silver_laps(laps, RUN)
    ds, dd = gold.build_dim_sessions(ss), gold.build_dim_drivers(sd)
    fact = gold.build_fact_laps(sl)
    return {"ss": ss, "sd": sd, "sl": sl, "ds": ds, "dd": dd, "fact": fact}


def test_silver_sessions(layers):
    got = {r.session_key: r for r in layers["ss"].collect()}
    assert set(got) == {1, 2}
    assert (got[1].session_name, got[1].session_category, got[1].session_duration_minutes) == ("Race", "Race", 150.0)
    assert (got[2].session_name, got[2].session_category, got[2].session_type) == ("Unknown", "Other", "Practice")
    assert got[2].session_duration_minutes is None and got[2].location == "Unknown"


def test_silver_drivers(layers):
    got = {r.driver_number: r for r in layers["sd"].collect()}
    assert set(got) == {7, 8, 9, 10}
    assert got[7].broadcast_name == "Ann A"
    assert (got[8].broadcast_name, got[8].full_name) == ("Bob B", None)
    assert (got[8].team_name, got[8].team_category, got[8].team_colour) == ("Unknown Team", "Other", "000000")
    assert (got[9].full_name, got[9].team_category) == ("C C", "RB")


def test_silver_laps(layers):
    got = {(r.session_key, r.driver_number, r.lap_number): r for r in layers["sl"].collect()}
    assert len(got) == 12
    assert got[1, 7, 2].max_speed == 310 and got[1, 7, 3].max_speed == 0
    assert got[1, 7, 2].calculated_lap_duration == 89.0
    assert got[1, 7, 2].sector_duration_delta == 1.0
    assert got[1, 7, 5].sector_duration_delta is None
    assert got[1, 7, 1].sector_completeness == "Partial"
    assert [got[1, 10, n].is_valid_lap for n in (1, 2)] == [True, True]
    assert [got[1, 8, n].is_valid_lap for n in (1, 2)] == [False, False]


def test_fact_ranks(layers):
    got = {(r.session_key, r.driver_number, r.lap_number): r for r in layers["fact"].collect()}
    # The untimed lap and the invalid 9.999 take ranks 1 and 2.
    assert got[1, 10, 1].session_lap_time_rank == 3
    assert got[1, 7, 5].session_lap_time_rank is None
    assert got[1, 7, 3].driver_lap_rank == 3
    assert got[1, 7, 3].delta_to_personal_best == 0.5
    assert got[1, 7, 4].is_personal_best_lap and not got[1, 7, 4].is_valid_lap
    assert got[1, 8, 1].driver_best_lap_time is None and not got[1, 8, 1].is_personal_best_lap


def test_fact_ranks_last(layers):
    got = gold.build_fact_laps(layers["sl"], nulls="last").filter("driver_number = 10 AND lap_number = 1")
    assert got.first().session_lap_time_rank == 2


def test_ranks_of_a_large_session(spark):
    """One session with a third of the laps: the ranks of slices equal one plain order."""
    laps = [
        lap(1 if n % 3 == 0 else n, n % 7, n, None if n % 5 == 0 else 60.0 + n * 37 % 90 / 4)
        for n in range(1, 121)
    ]
    silver_laps = silver.build_silver_laps(frame(spark, "laps", laps), RUN)
    for nulls in ("first", "last"):
        got = gold.rank_laps(silver_laps, nulls).filter("is_valid_lap").collect()
        want = silver_laps.selectExpr(
            "session_key", "lap_number", f"""row_number() over (partition by session_key order by
            lap_duration nulls {nulls}, driver_number, lap_number) as n""",
        )
        by_lap = {(r.session_key, r.lap_number): r.n for r in want.collect()}
        assert got and all(r.session_lap_time_rank == by_lap[r.session_key, r.lap_number] for r in got)


def test_no_job_while_plans_are_built(spark, layers):
    context = spark.sparkContext
    context.setJobGroup("planning", "plans only")
    try:
        fact = gold.build_fact_laps(layers["sl"])
        marts.build_session_leaderboard(fact, layers["ds"], layers["dd"], RUN)
        assert not context.statusTracker().getJobIdsForGroup("planning")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_means_keep_small_values(spark):
    df = spark.createDataFrame([(1e-6,), (3e-6,), (None,)], "v double")
    assert df.agg(C.mean("v").alias("m")).first().m == 2e-6
    assert spark.createDataFrame([(0.1,), (0.2,)], "v double").agg(C.mean("v")).first()[0] == 0.15


def test_summary(layers):
    df = marts.build_driver_session_summary(layers["fact"], layers["ds"], layers["dd"], RUN)
    got = {r.driver_number: r for r in df.collect()}
    assert set(got) == {7, 8, 9, 10}  # 99 has no driver row, session 3 no session row
    a = got[7]
    assert (a.total_laps, a.valid_laps, a.pit_out_laps, a.valid_lap_percentage) == (5, 2, 2, 40.0)
    assert (a.fastest_lap_time, a.slowest_lap_time, a.avg_lap_time) == (90.0, 90.5, 90.25)
    assert (a.lap_time_stddev, a.lap_time_range) == (0.354, 0.5)
    assert (a.theoretical_best_lap, a.top_speed, a.complete_sector_laps) == (88.5, 310, 2)
    assert got[8].valid_laps == 0 and got[8].fastest_lap_time is None
    assert got[8].theoretical_best_lap == 0.0
    assert got[9].lap_time_stddev is None and got[9].consistency_coefficient is None


def test_leaderboard(layers):
    df = marts.build_session_leaderboard(layers["fact"], layers["ds"], layers["dd"], RUN)
    got = {r.driver_number: r for r in df.collect()}
    assert set(got) == {7, 9, 10}
    assert [got[d].position for d in (10, 7, 9)] == [1, 2, 3]  # 7 and 9 tie: lower number first
    assert [got[d].team_position for d in (10, 7, 9)] == [1, 2, 1]
    assert got[7].delta_to_fastest == 80.0 and got[7].gap_percentage == 800.0
    assert got[10].is_fastest and not got[7].is_fastest and got[9].is_fastest_in_team
    assert (got[7].fastest_lap_number, got[7].lap_of_fastest) == (2, 2)


def test_lap_of_fastest_differs_from_first_valid(spark):
    laps = frame(spark, "laps", [lap(1, 7, 3, 95.0), lap(1, 7, 4, 90.0), lap(1, 7, 6, 90.0)])
    got = marts.fastest_laps(gold.build_fact_laps(silver.build_silver_laps(laps, RUN))).first()
    assert (got.fastest_lap_number, got.lap_of_fastest) == (3, 4)


def test_team_performance(layers):
    summary = marts.build_driver_session_summary(layers["fact"], layers["ds"], layers["dd"], RUN)
    got = {r.team_name: r for r in marts.build_team_performance(summary, RUN).collect()}
    assert set(got) == {"Ferrari", "RB", "Other"}
    f = got["Ferrari"]
    assert (f.drivers_count, f.team_total_laps, f.team_valid_laps) == (2, 7, 4)
    assert (f.team_fastest_lap, f.team_avg_fastest_lap, f.intra_team_gap) == (10.0, 50.0, 40.0)
    assert [got[t].team_rank for t in ("Other", "Ferrari", "RB")] == [1, 2, 3]
    last = {r.team_name: r.team_rank for r in marts.build_team_performance(summary, RUN, "last").collect()}
    assert last == {"Ferrari": 1, "RB": 2, "Other": 3}


def test_locations(spark):
    df = frame(spark, "locations", [
        {"session_key": 1, "driver_number": 7, "date": "2024-03-02T15:00:00", "x": 3, "y": 4, "z": None},
        {"session_key": 1, "driver_number": 7, "date": "2024-03-02T15:00:01", "x": None, "y": 4, "z": 1},
        {"session_key": 1, "driver_number": 7, "date": None, "x": 1, "y": 4, "z": 1},
    ])
    got = silver.build_silver_locations(df, RUN).collect()
    assert [(r.position_x, r.position_y, r.position_z, r.distance_from_origin) for r in got] == [(3, 4, 0, 5.0)]


def test_fact_shuffles(spark, tmp_path):
    """Whole laps are read once and move twice: to rank a slice, and for both columns per driver.

    The totals of the two levels of slices add five small exchanges, of which one repeats another
    and is run once. They read three columns.
    """
    path = str(tmp_path / "laps")
    laps = frame(spark, "laps", [lap(1, 7, n, 90.0 + n) for n in range(5)])
    silver.build_silver_laps(laps, RUN).write.parquet(path)
    plan = gold.build_fact_laps(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 7 and "SinglePartition" not in plan
    read = [x.split(",") for x in re.findall(r"FileScan parquet \[([^]]*)\]", plan)]
    assert sorted(len(r) > 3 for r in read) == [False, False, True]


def test_whole_laps_move_once(spark, tmp_path):
    """Laps are dealt by driver only; slices bring their offsets along and nothing is joined to laps."""
    path = str(tmp_path / "laps")
    laps = frame(spark, "laps", [
        lap(1, d, n, t) for d, n, t in
        [(7, 1, 90.0), (7, 2, None), (7, 2, 90.0), (8, 1, 90.0), (None, 3, 91.0), (8, 2, 8.0), (7, 1, 90.0)]
    ])
    silver.build_silver_laps(laps, RUN).unionByName(
        silver.build_silver_laps(laps.filter("lap_number = 2"), RUN).withColumn("driver_number", F.lit(None).cast("long"))
    ).write.parquet(path)
    fact = gold.build_fact_laps(spark.read.parquet(path))
    plan = fact._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]
    wide = [x for x in plan.split("\n") if "Join" in x]
    assert all("driver_number" not in x for x in wide)
    whole = "lap_number, date_start, lap_duration, is_pit_out_lap, updated_at, speed_trap_speed, max_speed"
    plain = spark.read.parquet(path).selectExpr(
        "*", f"row_number() OVER (PARTITION BY session_key ORDER BY lap_duration, driver_number, {whole}) AS t",
        f"row_number() OVER (PARTITION BY session_key, driver_number ORDER BY {whole}) AS d",
    ).selectExpr("driver_number", "lap_number", "lap_duration", "IF(is_valid_lap, t, NULL) AS t", "d")
    names = ["driver_number", "lap_number", "lap_duration", "session_lap_time_rank", "driver_lap_rank"]
    got = sorted(map(str, fact.select(*names).toDF(*plain.columns).collect()))
    assert got == sorted(map(str, plain.collect())) and len(got) == 9
