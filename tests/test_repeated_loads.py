"""Loads that stop anywhere, run twice, or meet other writers."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from stintlake.plans import build, gold_changes
from stintlake.sources import batches, parts, writers

TS = "2024-06-01 00:00:00"


@pytest.fixture
def bronze(spark, tmp_path):
    """A path with small bronze tables, and a function that adds a load to them."""
    path = str(tmp_path)
    sf = "/root/testdata/sf0.001"
    from stintlake.plans.warehouse import Warehouse

    w = Warehouse.over_tables(spark, sf, TS)
    tables = {n: w.table(f"bronze_{n}") for n in ("sessions", "drivers", "laps", "locations")}

    def load(part, when=None):
        for name, df in tables.items():
            rows = df.filter(F.pmod("session_key", F.lit(3)) == part)
            if when:
                rows = rows.withColumn("_ingestion_timestamp", F.lit(when).cast("timestamp"))
            rows.coalesce(1).write.mode("append").parquet(f"{path}/bronze_{name}")

    load(0)
    return path, load, tables


def counts(spark, path):
    return {n: writers.read_table(spark, f"{path}/silver_{n}").count() for n in ("sessions", "drivers", "laps", "locations")}


STOPS = ["before plan", "after plan", "rows", "after rows", "before end"]


@pytest.mark.parametrize("stop", STOPS)
def test_stop_at_every_write_then_rerun(spark, bronze, monkeypatch, stop):
    path, load, _ = bronze
    build.refresh_silver(spark, path, TS)
    load(1)

    class Stopped(Exception):
        pass

    def stopping(real, when, after=False):
        left = [2]  # the second call stops, so that one table is done before

        def run(*args, **kwargs):
            if when(*args):
                left[0] -= 1
                if left[0] == 0:
                    if after:
                        real(*args, **kwargs)
                    raise Stopped
            return real(*args, **kwargs)

        return run

    with monkeypatch.context() as m:
        always = lambda *a: True
        if stop in ("before plan", "after plan"):
            m.setattr(batches, "claim", stopping(batches.claim, always, stop == "after plan"))
        elif stop in ("rows", "after rows"):
            m.setattr(batches, "write_table", stopping(batches.write_table, always, stop == "after rows"))
        else:
            m.setattr(writers, "claim", stopping(writers.claim, always))
        with pytest.raises(Stopped):
            build.refresh_silver(spark, path, TS)
    build.refresh_silver(spark, path, TS)
    once = counts(spark, path)
    assert writers.read_table(spark, f"{path}/silver_laps").columns.count("batch_day") == 1
    build.refresh_silver(spark, path, TS, full=True)
    assert counts(spark, path) == once
    keys = writers.read_table(spark, f"{path}/silver_drivers").groupBy("session_key", "driver_number").count()
    assert keys.filter("count > 1").count() == 0


def test_a_load_committed_late_is_taken(spark, bronze):
    """Its rows carry an older time than what the table has already."""
    path, load, _ = bronze
    build.refresh_silver(spark, path, TS)
    load(1, "1990-01-01 00:00:00")
    build.refresh_silver(spark, path, TS)
    late = counts(spark, path)
    build.refresh_silver(spark, path, TS, full=True)
    assert counts(spark, path) == late


def test_incomplete_batches_are_not_read(spark, bronze):
    path, load, _ = bronze
    build.refresh_silver(spark, path, TS)
    before = counts(spark, path)
    folder = f"{path}/silver_laps/batch=7/batch_day=2000-01-01"
    os.makedirs(folder)
    source = glob.glob(f"{path}/silver_laps/batch=0/**/*.parquet", recursive=True)[0]
    os.link(source, f"{folder}/part-0.parquet")
    assert counts(spark, path) == before


def test_two_loads_that_begin_at_once(spark, bronze, monkeypatch):
    path, load, _ = bronze
    build.refresh_silver(spark, path, TS)
    load(1)
    names = batches.list_names(spark, f"{path}/silver_laps/_plans")
    assert batches.claim(spark, f"{path}/silver_laps/_plans/{1:012d}", "")  # begun, not written out
    monkeypatch.setattr(batches, "list_names", lambda s, p: names if "silver_laps" in p else writers.list_names(s, p))
    with pytest.raises(RuntimeError, match="began meanwhile"):
        build.refresh_silver(spark, path, TS)
    monkeypatch.undo()
    build.refresh_silver(spark, path, TS)
    laps = counts(spark, path)["laps"]
    build.refresh_silver(spark, path, TS, full=True)
    assert counts(spark, path)["laps"] == laps


def test_two_writers_of_one_table(spark, tmp_path):
    """Both began from one state; the second is refused, and the first one's rows stay."""
    path = str(tmp_path / "t")
    writers.replace_table(spark.range(1), path)
    numbers = [writers.next_pointer(spark, path)] * 2
    versions = ["a", "b"]
    for v in versions:
        spark.range(5 if v == "a" else 9).write.parquet(writers.version_path(path, v))
    writers.switch_version(spark, path, versions[0], numbers[0])
    with pytest.raises(RuntimeError, match="another writer"):
        writers.switch_version(spark, path, versions[1], numbers[1])
    assert writers.read_table(spark, path).count() == 5


def test_a_pointer_without_content_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(spark.range(4), path)
    (tmp_path / "t" / "_pointers" / f"{1:012d}").write_text("")
    assert writers.read_table(spark, path).count() == 4
    writers.replace_table(spark.range(6), path)
    assert writers.read_table(spark, path).count() == 6


def files(path):
    found = glob.glob(f"{path}/_versions/**/*.parquet", recursive=True)
    return {f: os.stat(f).st_mtime_ns for f in found}


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["k"]
    change = lambda old, new: new if old is None else old.join(new, "k", "left_anti").unionByName(new)
    parts.change_buckets(path, spark.range(500).selectExpr("id AS k", "0 AS v"), keys, change, 16)
    before = files(path)
    touched = parts.change_buckets(path, spark.createDataFrame([(3, 1), (900, 1)], "k long, v int"), keys, change, 16)
    assert 1 <= len(touched) <= 2
    named = {f for _, folder in writers.current_parts(spark, path) for f in glob.glob(f"{folder}/*.parquet")}
    kept = [f for f in before if f in named]
    assert {int(f.split("_key_bucket=")[1].split("/")[0]) for f in kept} == set(range(16)) - set(touched)
    assert all(before[f] == os.stat(f).st_mtime_ns for f in kept)
    rows = {r.k: r.v for r in writers.read_table(spark, path).collect()}
    assert rows == {**dict.fromkeys(range(500), 0), 3: 1, 900: 1}
    assert parts.change_buckets(path, spark.createDataFrame([], "k long, v int"), keys, change, 16) == []
    with pytest.raises(ValueError):
        parts.change_buckets(path, spark.range(1).selectExpr("id AS k", "0 AS v"), keys, change, 8)


def test_an_empty_first_batch_leaves_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    parts.change_buckets(path, spark.createDataFrame([], "k long"), ["k"], lambda old, new: new)
    assert writers.read_table(spark, path).columns == ["k"] and writers.read_table(spark, path).count() == 0


def test_closed_history_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    step = lambda rows: lambda opened: rows
    make = lambda *rows: spark.createDataFrame(list(rows), "k int, valid_to string")
    parts.append_history(spark, path, step(make((1, None), (2, None))), "valid_to IS NULL")
    parts.append_history(spark, path, step(make((1, "t1"), (2, None))), "valid_to IS NULL")
    before = {f: t for f, t in files(path).items() if "/closed/" in f}
    parts.append_history(spark, path, lambda opened: opened.unionByName(make((3, None))), "valid_to IS NULL")
    assert before and all(files(path).get(f) == t for f, t in before.items())
    assert sorted((r.k, r.valid_to) for r in writers.read_table(spark, path).collect()) == [(1, "t1"), (2, None), (3, None)]


def test_a_named_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k int")
    writers.append_table(rows(1, 2), path, "2024/01", dedupe_keys=["k"])
    for _ in range(2):
        writers.append_table(rows(2, 3, 3), path, "b2", dedupe_keys=["k"])
    got = sorted((r.k, r._ingestion_batch_id) for r in writers.read_table(spark, path).collect())
    assert got == [(1, "2024/01"), (2, "2024/01"), (3, "b2")]


GOLD = ("fact_laps", "driver_session_summary", "session_leaderboard", "team_performance", "dim_sessions", "dim_drivers")


def gold_rows(spark, path):
    stamps = ("created_at", "updated_at", "valid_from")
    tables = {n: writers.read_table(spark, f"{path}/{n}") for n in GOLD}
    return {n: sorted(map(repr, df.select(*sorted(set(df.columns) - {*stamps})).collect())) for n, df in tables.items()}


def test_gold_by_changed_sessions_equals_a_full_one(spark, bronze):
    """New laps, a new driver row and a new session; untouched buckets keep their files."""
    path, load, tables = bronze
    build.refresh_silver(spark, path, TS)
    build.refresh_gold(spark, path, TS)
    before = {n: dict(writers.current_parts(spark, f"{path}/{n}")) for n in gold_changes.BUCKETED}
    one = tables["laps"].filter("session_key = 199805")  # in no load of the fixture yet
    one.coalesce(1).write.mode("append").parquet(f"{path}/bronze_laps")
    build.refresh_silver(spark, path, TS)
    build.refresh_gold(spark, path, TS)
    touched = parts.touched_buckets(one, ["session_key"], gold_changes.SESSION_BUCKETS)
    after = {n: dict(writers.current_parts(spark, f"{path}/{n}")) for n in gold_changes.BUCKETED}
    assert len(touched) == 1 and one.count() > 0
    for name, folders in before.items():
        same = {label for label, f in folders.items() if after[name].get(label) == f}
        assert {int(label.split("/")[1]) for label in set(folders) - same} <= touched, name
    assert writers.read_table(spark, f"{path}/fact_laps").filter("session_key = 199805").count() > 0
    load(1)  # drivers of other days move the driver dimension, and marts with it
    build.refresh_silver(spark, path, TS)
    build.refresh_gold(spark, path, TS)
    changed = gold_rows(spark, path)
    assert all(changed.values())
    build.refresh_gold(spark, path, TS)  # nothing new
    assert gold_rows(spark, path) == changed
    build.refresh_gold(spark, path, TS, full=True)
    assert gold_rows(spark, path) == changed
    build.refresh_silver(spark, path, TS, full=True)  # new versions of the laps: everything anew
    build.refresh_gold(spark, path, TS)
    assert gold_rows(spark, path)["fact_laps"] == changed["fact_laps"]


@pytest.mark.parametrize("stop", [2, 5])
def test_gold_stopped_at_a_table_then_rerun(spark, bronze, monkeypatch, stop):
    """Tables become current in turn: facts, three marts, two dimensions."""
    path, load, _ = bronze
    build.refresh_silver(spark, path, TS)
    build.refresh_gold(spark, path, TS)
    load(1)
    build.refresh_silver(spark, path, TS)
    calls = []

    def stopping(real):
        def run(*args, **kwargs):
            calls.append(1)
            if len(calls) == stop:
                raise InterruptedError
            return real(*args, **kwargs)

        return run

    with monkeypatch.context() as m:
        m.setattr(parts, "replace_parts", stopping(parts.replace_parts))
        m.setattr(gold_changes, "replace_table", stopping(gold_changes.replace_table))
        with pytest.raises(InterruptedError):
            build.refresh_gold(spark, path, TS)
    build.refresh_gold(spark, path, TS)
    rerun = gold_rows(spark, path)
    build.refresh_gold(spark, path, TS, full=True)
    assert gold_rows(spark, path) == rerun


def test_load_ranks_only_its_sessions(spark):
    """Facts of a session that the load does not bring stay; the others are ranked with the new laps."""
    from pyspark.sql import functions as F

    from stintlake.plans import gold, gold_changes, silver
    from stintlake.sources.schemas import DDL

    def laps(*rows):
        wide = spark.createDataFrame(rows, "session_key long, driver_number long, lap_number long, lap_duration double")
        known = spark.createDataFrame([], DDL["laps"]).withColumn("_ingestion_timestamp", F.lit(None).cast("timestamp"))
        return silver.build_silver_laps(known.unionByName(wide, allowMissingColumns=True), "2024-02-01 00:00:00")

    first = laps((1, 7, 1, 90.0), (2, 7, 1, 95.0)).withColumn("_load", F.lit(0))
    old = gold.build_fact_laps(first, carried=["_load"]).withColumn(
        "driver_lap_rank", F.when(F.col("session_key") == 2, 99).otherwise(F.col("driver_lap_rank")).cast("long")
    )
    got = gold_changes.ranked_with(old, laps((1, 7, 2, 80.0)), 1)
    assert "lap_key" not in got.columns
    rows = gold.with_lap_keys(got, ["_load"])
    assert rows.columns == old.columns
    names = ["session_key", "lap_number", "driver_lap_rank", "session_lap_time_rank", "_load"]
    assert sorted(map(tuple, rows.select(*names).collect())) == [(1, 1, 1, 2, 0), (1, 2, 2, 1, 1), (2, 1, 99, 1, 0)]
