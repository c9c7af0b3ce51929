"""Readers, writers and named tables."""

import json

import pytest
from pyspark.sql import functions as F

from stintlake.plans import build
from stintlake.plans.build import (
    build_all,
    load_bronze,
    load_new_files,
    refresh_gold,
    refresh_silver,
)
from stintlake.plans import reports
from stintlake.plans.warehouse import Warehouse
from stintlake.session import drop_stages, stage
from stintlake.sources import catalog, readers, writers
from stintlake.sources.schemas import entity_schema


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(records, indent=2))


def lap(s, d, n, t, day="2024-03-02", **more):
    return {"session_key": s, "driver_number": d, "lap_number": n, "lap_duration": t,
            "batch_day": day, "segments_sector_1": [2049, None, 2051], **more}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    land(folder, "sessions_a.json", [{"session_key": 1, "session_name": "Race", "year": 2024,
                                      "date_start": "2024-03-02T15:00:00+00:00", "date_end": "bad"}])
    land(folder, "drivers_a.json", {"session_key": 1, "driver_number": 7, "full_name": "Ann", "team_name": "Ferrari"})
    land(folder, "laps_a.json", [lap(1, 7, 1, 90.0), lap(1, 7, 2, 91.0)])
    land(folder, "laps_b.json", [lap(1, 7, 3, 92.5, "2024-03-03", weather="dry")])
    land(folder, "locations_a.json", [{"session_key": 1, "driver_number": 7, "date": "2024-03-02T15:00:01",
                                       "x": 1, "y": 2, "batch_day": "2024-03-02"}])
    return folder


def test_arrays_single_records_and_union_of_fields(spark, landing):
    one = readers.read_entity(spark, str(landing), "drivers", typed=False)
    assert [r.driver_number for r in one.collect()] == [7]
    laps = readers.read_entity(spark, str(landing), "laps", typed=False)
    assert sorted((r.lap_number, r.weather) for r in laps.collect()) == [(1, None), (2, None), (3, "dry")]


def test_typed_read(spark, landing):
    r = readers.read_entity(spark, str(landing), "sessions", batch_id="b1").first()
    assert str(r.date_start_ts) == "2024-03-02 15:00:00" and r.date_end_ts is None
    assert r._source_file.endswith("sessions_a.json") and r._ingestion_batch_id == "b1"
    assert r._ingestion_timestamp is not None
    laps = readers.read_entity(spark, str(landing), "laps")
    assert laps.schema["session_key"].dataType.typeName() == "long"
    assert laps.first().segments_sector_1 == [2049, None, 2051]


def test_entity_settings():
    with pytest.raises(KeyError):
        entity_schema("weather")
    assert readers.file_pattern("laps") == "laps*.json"
    assert readers.file_pattern("weather") == "weather*.json"
    assert readers.table_comment("weather") == "Raw weather data"
    assert readers.table_properties("laps")["layout.columns"] == "session_key,driver_number,lap_number"


def test_unprocessed_files(spark, landing, tmp_path):
    path = str(tmp_path / "tables")
    assert load_new_files(spark, str(landing), path, "laps", max_files=1) == 2
    assert load_new_files(spark, str(landing), path, "laps") == 0
    land(landing, "laps_c.json", [lap(2, 7, 1, 80.0, "2024-03-04")])
    assert load_new_files(spark, str(landing), path, "laps") == 1
    assert writers.read_table(spark, f"{path}/bronze_laps").count() == 4


def test_load_of_files_without_rows_ends(spark, landing, tmp_path):
    path = str(tmp_path / "tables")
    land(landing, "laps_empty.json", [])
    assert load_new_files(spark, str(landing), path, "laps") == 3
    assert load_new_files(spark, str(landing), path, "laps") == 0


def test_load_stopped_before_the_log(spark, landing, tmp_path, monkeypatch):
    """Rows are there, the log is not: the next load writes the same folder again."""
    path = str(tmp_path / "tables")
    write = build.write_table

    def stop(df, target, *rest):
        if "_files" in target:
            raise RuntimeError("stopped")
        return write(df, target, *rest)

    monkeypatch.setattr(build, "write_table", stop)
    with pytest.raises(RuntimeError):
        load_new_files(spark, str(landing), path, "laps")
    monkeypatch.undo()
    assert load_new_files(spark, str(landing), path, "laps") == 2
    assert writers.read_table(spark, f"{path}/bronze_laps").count() == 3


def test_one_way_of_loading_per_table(spark, landing, tmp_path):
    path = str(tmp_path / "tables")
    load_bronze(spark, str(landing), path, "laps")
    with pytest.raises(ValueError):
        load_new_files(spark, str(landing), path, "laps")
    load_new_files(spark, str(landing), path, "drivers")
    with pytest.raises(ValueError):
        load_bronze(spark, str(landing), path, "drivers")


def test_quality_and_snapshot_tables(spark, landing, tmp_path):
    path = str(tmp_path / "tables")
    land(landing, "laps_bad.json", [lap(None, 7, 9, 80.0), lap(1, 7, 10, -1.0)])
    for entity in ("sessions", "drivers", "laps", "locations"):
        load_bronze(spark, str(landing), path, entity)
    build.load_quality(spark, path)
    build.load_quality(spark, path)
    assert spark.read.parquet(f"{path}/quality_laps").count() == 4
    failed = spark.read.parquet(f"{path}/quality_laps_counts").groupBy("expectation").sum("failed_records")
    assert dict(map(tuple, failed.collect())) == {
        "valid_session_key": 1, "valid_driver_number": 0, "valid_lap_duration": 1
    }
    for name, run_ts in (("first", "2024-06-01 00:00:00"), ("second", "2024-06-02 00:00:00")):
        refresh_silver(spark, path, run_ts, full=True)
        build.refresh_snapshots(spark, path, run_ts)
    drivers = writers.read_table(spark, f"{path}/driver_snapshot").orderBy("valid_from").collect()
    assert [r.valid_to is None for r in drivers] == [False, True]


def test_layers_from_landing_files(spark, landing, tmp_path):
    """Load, refresh, land more, refresh again: rows are merged or appended once."""
    path = str(tmp_path / "tables")
    for entity in ("sessions", "drivers", "laps", "locations"):
        load_bronze(spark, str(landing), path, entity)
    refresh_silver(spark, path, "2024-06-01 00:00:00")
    refresh_gold(spark, path, "2024-06-01 00:00:00")
    w = Warehouse.at_path(spark, path)
    assert (w.silver_laps.count(), w.fact_laps.count(), w.session_leaderboard.count()) == (3, 3, 1)

    land(landing, "laps_z.json", [lap(1, 7, 4, 70.0)])
    land(landing, "drivers_z.json", [{"session_key": 1, "driver_number": 7, "full_name": "Else", "team_name": "Williams"}])
    for entity in ("drivers", "laps"):
        load_bronze(spark, str(landing), path, entity)
    refresh_silver(spark, path, "2024-06-02 00:00:00")
    refresh_gold(spark, path, "2024-06-02 00:00:00")
    w = Warehouse.at_path(spark, path)
    d = w.silver_drivers.first()
    # Only the merged columns change: the category keeps the value of the first load.
    assert (d.team_name, d.full_name, d.team_category) == ("Williams", "Ann", "Ferrari")
    assert w.silver_laps.count() == 4
    best = w.session_leaderboard.first()
    assert (best.fastest_lap_time, best.fastest_lap_number, best.lap_of_fastest) == (70.0, 1, 4)
    assert w.team_performance.count() == 1


def test_build_all_equals_lazy_models(spark, tmp_path, rows):
    lazy = Warehouse.over_tables(spark, "/root/testdata/sf0.001", "2024-02-01 00:00:00")
    built = build_all(lazy, spark, str(tmp_path / "all"), "2024-02-01 00:00:00")
    for name in ("session_leaderboard", "driver_session_summary", "team_performance"):
        a = lazy.table(name).drop("created_at")
        assert rows(a) == rows(built.table(name).select(*a.columns)), name


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("d1", 1), ("d2", 2), ("d2", 3)], "batch_day string, v int")
    writers.write_table(df, path, partition_by=["batch_day"])
    read = writers.read_table(spark, path).filter("batch_day = 'd2'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_day" in plan and read.count() == 2
    new = spark.createDataFrame([("d2", 9)], "batch_day string, v int")
    writers.write_table(new, path, partition_by=["batch_day"], dynamic=True)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    writers.write_table(new, path, partition_by=["batch_day"])
    assert [r.v for r in spark.read.parquet(path).collect()] == [9]


def test_days_stay_text_and_prune(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("2024-03-02", 1), ("2024-03-03", 2)], "batch_day string, v int")
    writers.replace_table(df, path, ["batch_day"])
    read = writers.read_table(spark, path)
    assert read.schema["batch_day"].dataType.typeName() == "string"
    one = read.filter("batch_day = '2024-03-03'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "2024-03-03" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert [r.v for r in one.collect()] == [2]


def test_replace_table_reads_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(spark.range(5).toDF("v"), path)
    for _ in range(3):
        old = writers.read_table(spark, path)
        writers.replace_table(old.withColumn("v", F.col("v") + 1), path)
    assert sorted(r.v for r in writers.read_table(spark, path).collect()) == [3, 4, 5, 6, 7]
    assert len(list((tmp_path / "t" / "_versions").glob("[0-9a-f]*"))) == 2  # this and the last


def test_replacement_stopped_before_the_switch(spark, tmp_path, monkeypatch):
    path, new = str(tmp_path / "t"), str(tmp_path / "new")

    def stop(*_):
        raise RuntimeError("stopped")

    writers.replace_table(spark.range(2).toDF("v"), path)
    monkeypatch.setattr(writers, "switch_version", stop)
    for target in (path, new):
        with pytest.raises(RuntimeError):
            writers.replace_table(spark.range(9).toDF("v"), target)
    assert writers.read_table(spark, path).count() == 2
    assert not writers.table_exists(spark, new)


def test_clustered_files_hold_disjoint_ranges(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(4000).select((F.col("id") * 37 % 4000).alias("k"), F.rand(1).alias("v"))
    writers.write_table(df.repartition(4), path, cluster_by=["k"])
    spans = sorted(
        (r.lo, r.hi) for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(
            F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    )
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_compaction(spark, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    spark.range(1000).repartition(40).write.parquet(small)
    writers.compact(spark.read.parquet(small), packed)
    assert len(spark.read.parquet(packed).inputFiles()) < 40
    assert spark.read.parquet(packed).distinct().count() == 1000


def test_compaction_keeps_clusters_apart(spark, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    writers.write_table(spark.range(4000).selectExpr("id * 37 % 4000 AS k"), small, cluster_by=["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.compact(spark.read.parquet(small), packed, ["k"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = sorted(
        (r.lo, r.hi) for r in spark.read.parquet(packed).groupBy(F.col("_metadata.file_path")).agg(
            F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    )
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "a")
    writers.append_table(spark.createDataFrame([(1, "a")], "k int, v string"), path, "b1")
    writers.append_table(spark.createDataFrame([(2, "b", 5)], "k int, v string, w int"), path, "b2")
    got = sorted((r.k, r.w, r._ingestion_batch_id) for r in writers.read_table(spark, path, evolving=True).collect())
    assert got == [(1, None, "b1"), (2, 5, "b2")]
    again = spark.createDataFrame([(2, "b", 5), (3, "c", 6)], "k int, v string, w int")
    writers.append_table(again, path, "b3", dedupe_keys=["k"])
    assert sorted(r.k for r in writers.read_table(spark, path).collect()) == [1, 2, 3]


def test_drop_stages(spark, tmp_path):
    df = stage(spark.range(3), "gone")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert writers.table_exists(spark, path)
    drop_stages(spark)
    assert not writers.table_exists(spark, path)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, None])], "k int, a array<int>")
    out = writers.export_json(df, str(tmp_path / "j"))
    back = spark.read.json(out)
    assert "ingestion_timestamp" in back.columns and back.first().a == [1, None]
    text = writers.export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(text).first().a == "[1,null]"


def test_named_tables_and_missing_ones(spark):
    """A schema with bronze tables only: the rest is built on demand."""
    lazy = Warehouse.over_tables(spark, "/root/testdata/sf0.001", "2024-02-01 00:00:00")
    catalog.create_schema(spark, "layers_test")
    for name in ("bronze_sessions", "bronze_drivers", "bronze_laps"):
        catalog.save_table(lazy.table(name), f"layers_test.{name}")
    w = Warehouse.in_schema(spark, "layers_test")
    assert w.session_leaderboard.count() == lazy.session_leaderboard.count() > 0
    assert reports.some_rows(w.silver_sessions, 3).count() == 3


def test_catalog(spark):
    catalog.create_schema(spark, "bronze_test")
    catalog.create_schema(spark, "bronze_test")
    df = spark.createDataFrame([(1,), (2,)], "k int")
    catalog.save_table(df, "bronze_test.laps", "Raw lap timing data", {"quality": "bronze"})
    catalog.save_table(df.withColumn("w", F.lit("x")), "bronze_test.laps")  # new columns too
    assert spark.table("bronze_test.laps").columns == ["k", "w"]
    catalog.save_table(df, "bronze_test.drivers", "It's raw", {"quality": "bronze"})
    assert "laps" in [r.tableName for r in catalog.list_tables(spark, "bronze_test").collect()]
    assert catalog.describe_table(spark, "bronze_test.drivers").first().col_name == "k"
    extended = catalog.describe_table(spark, "bronze_test.drivers", extended=True).collect()
    assert any(r.data_type == "It's raw" for r in extended)
    props = {r.key: r.value for r in catalog.show_properties(spark, "bronze_test.drivers").collect()}
    assert props["quality"] == "bronze"
    counts = catalog.count_tables(spark, ["bronze_test.laps", "bronze_test.none"]).collect()
    assert [(r.record_count, r.status) for r in counts] == [(2, "OK"), (None, "MISSING")]
    assert catalog.cache_table(spark, "bronze_test.laps").count() == 2
    assert spark.catalog.isCached("bronze_test.laps")
    spark.catalog.uncacheTable("bronze_test.laps")


def test_landed_lines_are_compressed(spark, tmp_path):
    """JSON repeats its names in every row; landed laps take a fraction of their text, and read back whole."""
    from stintlake.plans import registry

    rows = spark.range(0, 5000, 1, 1).selectExpr("id AS lap_number", "id % 20 AS driver_number", "'Session' AS session_name")
    plain = writers.export_json(rows, str(tmp_path / "plain"), stamp=False)
    small = writers.export_json(rows, str(tmp_path / "small"), stamp=False, compression="gzip", file_rows=2000)
    size = {p: sum(f.stat().st_size for f in (tmp_path / p).glob("part*")) for p in ("plain", "small")}
    assert 5 * size["small"] < size["plain"] and len(list((tmp_path / "small").glob("part*"))) == 3
    back = readers.read_json(spark, small, rows.schema, **registry.LINES)
    assert back.exceptAll(rows).isEmpty() and back.count() == 5000
    assert registry.LANDED["compression"] == "gzip" and spark.read.json(plain).count() == 5000
