"""Named queries over a directory of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv
from stintlake.operators import quality
from stintlake.operators.check_states import check_load, merged_checks
from stintlake.operators.chunks import (
    chunk_coverage,
    chunk_plan,
    coverage_of_counts,
    points_in_chunks,
)
from stintlake.operators.grouping import ranks, with_group_value
from stintlake.operators.incremental import incremental_read, merge_upsert
from stintlake.operators.profile import count_in_range, freshness, reconcile, stale
from stintlake.operators.quality import run_checks
from stintlake.operators.scd import (
    asof_join,
    interval_order_errors,
    scd2_from_history,
    version_overlaps,
)
from stintlake.operators.sessions import (
    race_sessions,
    recent_sessions,
    select_sessions,
    stamp_children,
)
from stintlake.operators.sketches import distinct_sketches, united_counts
from stintlake.plans import checks, reports, silver
from stintlake.plans.build import load_new_files, refresh_gold, refresh_silver, refresh_snapshots
from stintlake.plans.marts import build_team_performance
from stintlake.plans.snapshots import driver_snapshot, session_snapshot
from stintlake.plans.warehouse import BRONZE, Warehouse
from stintlake.session import fresh_path, stage
from stintlake.sources.batches import append_new_files
from stintlake.sources.catalog import (
    cache_table,
    count_tables,
    create_schema,
    describe_table,
    list_tables,
    save_table,
    show_properties,
    uncache_table,
)
from stintlake.sources.histories import insert_history, read_history
from stintlake.sources.parts import bucket_of, change_buckets
from stintlake.sources.readers import read_entity, read_json, table_comment, table_properties
from stintlake.sources.writers import (
    append_new,
    append_table,
    compact,
    current_parts,
    export_csv,
    export_json,
    read_table,
    replace_table,
    write_table,
)
from stintlake.streaming.coverage import chunk_count_stream, late_points, streamed_counts
from stintlake.streaming.expectations import (
    LAPS_DROP,
    LAPS_TRACK,
    LOCATIONS_DROP,
    expectation_counts,
    laps_quality,
    locations_quality,
)
from stintlake.streaming.ingest import (
    append_stream,
    chain_stream,
    checked_stream,
    evolving_stream,
    stream_entity,
)

RUN_TS = "2024-02-01 00:00:00"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, lists joined, and no run-time stamps: easy to compare."""
    cols = []
    for f in df.schema:
        if f.name in ("updated_at", "created_at"):
            continue
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws("|", F.col(f.name).cast("array<string>")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str):
    """Register a function of a warehouse under a name."""

    def wrap(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Warehouse.over_tables(spark, sf_dir, RUN_TS)))

        QUERIES[name] = run
        return fn

    return wrap


def _model(name: str) -> None:
    drop = ("_ingestion_timestamp", "valid_from", "valid_to")
    query(name)(lambda w: w.table(name).drop(*drop))


for _name in (
    "silver_sessions", "silver_drivers", "silver_laps", "silver_locations", "dim_sessions",
    "dim_drivers", "fact_laps", "driver_session_summary", "session_leaderboard",
    "team_performance",
):
    _model(_name)


# --- reports ------------------------------------------------------------------

for _name in (
    "bronze_counts", "expected_vs_actual", "latest_sessions", "latest_session_drivers",
    "latest_session_laps", "duplicate_sessions", "sessions_missing_drivers",
    "sessions_without_laps", "null_keys", "sessions_by_year", "sessions_by_type",
    "drivers_by_team", "lap_stats_by_type", "driver_participation", "metric_values",
    "bronze_freshness", "orphaned_drivers", "orphaned_bronze_laps", "laps_without_driver",
    "quick_health", "silver_counts", "silver_sessions_profile", "session_categories",
    "silver_drivers_profile", "top_participants", "silver_laps_profile", "lap_distribution",
    "silver_locations_profile", "points_per_session", "dim_sessions_profile",
    "sessions_per_category", "sessions_per_year", "dim_drivers_profile",
    "current_drivers_by_team", "fact_laps_profile", "lap_stats_by_session",
    "leaderboard_profile", "latest_leaderboard", "summary_profile", "top_performers",
    "team_profile", "team_board", "bronze_to_silver", "silver_to_gold",
    "session_duration_check", "unreasonable_laps", "silver_freshness", "silver_duplicates",
    "all_layer_health", "top_ten_per_session", "driver_performance", "race_team_ranking",
    "critical_nulls", "silver_gold_lineage", "first_position_flags", "team_driver_counts",
    "top_qualifying_laps", "consistency_ranking", "team_battle", "star_join_top_laps",
    "leaderboard_of", "team_rankings", "fastest_lap_per_driver", "session_list",
    "driver_season_stats", "sector_distribution", "newest_sessions", "fastest_valid_laps",
):
    query(_name)(getattr(reports, _name))

query("drivers_like")(lambda w: reports.drivers_like(w, "#00000001"))


# --- data quality -------------------------------------------------------------


def _checked(w: Warehouse, listed: dict) -> DataFrame:
    names = {*listed, "dim_sessions", "dim_drivers"} if "fact_laps" in listed else set(listed)
    return run_checks({n: w.table(n) for n in names}, listed)


query("dq_bronze")(lambda w: _checked(w, checks.BRONZE_CHECKS))
query("dq_silver")(
    lambda w: _checked(w, checks.SILVER_CHECKS)
)
query("dq_core")(
    lambda w: _checked(w, checks.CORE_CHECKS)
)
query("dq_marts")(
    lambda w: _checked(w, checks.MART_CHECKS)
)
query("orphaned_laps")(
    lambda w: checks.orphaned_laps(w.silver_laps, w.silver_drivers, w.silver_sessions)
)
query("summary_mismatches")(
    lambda w: checks.summary_mismatches(w.driver_session_summary, w.silver_laps)
)


@query("reconcile_bronze")
def _reconcile_bronze(w: Warehouse) -> DataFrame:
    """Lap counts of the summary against the landed rows, some of which lack a key."""
    keys = ["session_key", "driver_number"]
    landed = w.bronze_laps.groupBy(*keys).agg(F.count("*").alias("landed_laps"))
    return reconcile(w.driver_session_summary, landed, keys, [("total_laps", "landed_laps")])


query("fastest_lap_mismatches")(
    lambda w: checks.fastest_lap_mismatches(w.session_leaderboard, w.fact_laps, w.dim_sessions)
)


def _with_gaps(w: Warehouse) -> DataFrame:
    """The whole leaderboard, and for some sessions one more row far behind the last."""
    rows = w.session_leaderboard.select("session_key", "position")
    wrong = rows.filter("position = 1 AND session_key % 3 = 0")
    return rows.unionByName(wrong.withColumn("position", F.lit(1000).cast("long")))


query("position_gaps")(lambda w: checks.position_gaps(_with_gaps(w)))
query("position_steps")(lambda w: checks.position_steps(_with_gaps(w)))
query("team_count_mismatches")(
    lambda w: checks.team_count_mismatches(w.team_performance, w.silver_drivers)
)
query("not_one_current")(  # the whole history, and the versions of one team a second time
    lambda w: checks.not_one_current(
        _history(w).unionByName(_history(w).filter("team_category = 'Ferrari'"))
    )
)
query("no_future_dates")(
    lambda w: quality.no_future_dates(
        w.bronze_drivers, "_ingestion_timestamp", F.lit("2000-01-01").cast("timestamp")
    )
)
query("positive_values")(lambda w: quality.positive_values(w.bronze_laps, "duration_sector_3"))
query("reasonable_lap_time")(lambda w: quality.reasonable_lap_time(w.bronze_laps, "lap_duration"))
query("valid_percentage")(
    lambda w: quality.valid_percentage(w.session_leaderboard, "gap_percentage")
)
query("completeness")(
    lambda w: quality.completeness(
        w.bronze_laps, ["lap_duration", "duration_sector_1", "duration_sector_3", "st_speed"]
    )
)
query("lap_time_range")(
    lambda w: w.silver_laps.filter(~F.col("lap_duration").between(50, 300)).select(
        "session_key", "driver_number", "lap_number", "lap_duration"
    )
)
query("staleness")(
    lambda w: stale(
        freshness({n: w.table(n) for n in ("bronze_sessions", "bronze_drivers", "bronze_laps")}),
        "2001-11-05 06:30:00", fv.STALE_AFTER_HOURS,
    )
)
query("counts_in_range")(lambda w: count_in_range(reports.bronze_counts(w), fv.ROW_RANGES))


# --- incremental loads and history ---------------------------------------------


@query("hwm_read")
def _hwm_read(w: Warehouse) -> DataFrame:
    """Laps of the load batches after those already in the target."""
    target = w.bronze_laps.filter("_ingestion_timestamp <= '1998-01-01'")
    return incremental_read(w.bronze_laps, target).select(*silver.LAP_KEY, "lap_duration")


def _two_loads(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    early = w.bronze_drivers.filter("_ingestion_timestamp < '1998-06-15'")
    late = w.bronze_drivers.filter("_ingestion_timestamp >= '1998-06-15'")
    return silver.build_silver_drivers(early, w.run_ts), silver.build_silver_drivers(late, w.run_ts)


def _merged(w: Warehouse, update_all: bool) -> DataFrame:
    old, new = _two_loads(w)
    rows = merge_upsert(old, new, silver.DRIVER_KEY, silver.DRIVER_UPDATES, update_all, report=True)
    return rows.select(
        *silver.DRIVER_KEY, "team_name", "team_colour", "team_category", "_merge",
        F.to_date("_ingestion_timestamp").alias("ingested"),
    )


@query("merge_new_columns")
def _merge_new_columns(w: Warehouse) -> DataFrame:
    """A batch with one column that the target lacks, and without one that it has."""
    old, new = _two_loads(w)
    keys = silver.DRIVER_KEY
    return merge_upsert(
        old.select(*keys, "team_name", "team_colour"), new.select(*keys, "team_name", "country_code"),
        keys, ["team_name", "team_colour"], report=True,
    )


query("merge_partial")(lambda w: _merged(w, False))
query("merge_all")(lambda w: _merged(w, True))


@query("merge_touched")
def _merge_touched(w: Warehouse) -> DataFrame:
    """A merge that rewrites the key buckets of its batch; no other file may change."""
    old, new = _two_loads(w)
    spark, keys = old.sparkSession, silver.DRIVER_KEY
    path = fresh_path(spark, "merged")

    def merge(batch: DataFrame) -> None:
        change_buckets(
            path, batch, keys, lambda t, b: merge_upsert(t, b, keys, silver.DRIVER_UPDATES)
        )

    merge(old)
    before = dict(current_parts(spark, path))
    few = new.filter("session_key = 199901 AND driver_number < 12")
    merge(few)
    touched = few.select(bucket_of(keys).alias("bucket")).distinct()
    rows = read_table(spark, path).select(
        *keys, "team_name", "team_category", bucket_of(keys).alias("bucket"),
        F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"),
    )
    stale = [f"%{folder.split('/_versions/')[1]}" for folder in before.values()]
    kept = F.lit(False)
    for folder in stale:
        kept = kept | F.col("folder").like(folder)
    return rows.join(touched.withColumn("touched", F.lit(True)), "bucket", "left").select(
        *keys, "team_name", "team_category",
        (kept == F.coalesce("touched", F.lit(False))).alias("wrongly_placed"),
    )


@query("append_resumed")
def _append_resumed(w: Warehouse) -> DataFrame:
    """Laps appended in two loads, the second of which stops once and is run again.

    Rows of the second load were brought in under an older load time than those of the first.
    """
    bronze = w.bronze_laps
    spark = bronze.sparkSession
    source, target = fresh_path(spark, "bronze"), fresh_path(spark, "silver")

    def land(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(source)

    def build(rows: DataFrame) -> DataFrame:
        return silver.build_silver_laps(rows, w.run_ts)

    def stopping(rows: DataFrame) -> DataFrame:
        raise InterruptedError

    land(bronze.filter("_ingestion_timestamp >= '1998-01-01'"))
    append_new_files(spark, source, target, build, ["batch_day"])
    land(bronze.filter("_ingestion_timestamp < '1998-01-01' OR _ingestion_timestamp IS NULL"))
    try:
        append_new_files(spark, source, target, stopping, ["batch_day"])
    except InterruptedError:
        append_new_files(spark, source, target, build, ["batch_day"])
    append_new_files(spark, source, target, build, ["batch_day"])
    return read_table(spark, target).select(*silver.LAP_KEY, "lap_duration", "batch_day")


@query("gold_changed")
def _gold_changed(w: Warehouse) -> DataFrame:
    """The leaderboard after two loads, of which the second refreshes gold by its sessions only.

    Drivers of the second load move the driver dimension, and with it sessions of the first.
    """
    spark = w.bronze_laps.sparkSession
    path = fresh_path(spark, "layers")

    def load(which: str) -> None:
        for name in BRONZE:
            w.table(name).filter(which).write.mode("append").parquet(f"{path}/{name}")
        refresh_silver(spark, path, w.run_ts)
        refresh_gold(spark, path, w.run_ts)

    load("session_key < 199800 OR session_key IS NULL")
    load("session_key >= 199800")
    return read_table(spark, f"{path}/session_leaderboard")


@query("append_dedupe")
def _append_dedupe(w: Warehouse) -> DataFrame:
    """Rows to append from a batch that repeats one load of the target."""
    target = w.bronze_laps.filter("_ingestion_timestamp <= '1998-01-01'").dropna(
        subset=silver.LAP_KEY
    )
    batch = w.bronze_laps.filter("_ingestion_timestamp >= '1998-01-01'").dropna(
        subset=silver.LAP_KEY
    )
    return append_new(target, batch, silver.LAP_KEY, ["_ingestion_timestamp"]).select(
        *silver.LAP_KEY, "lap_duration"
    )


def _as_loaded(w: Warehouse, test: str) -> DataFrame:
    rows = w.silver_drivers.filter(test)
    return rows.withColumn("updated_at", F.col("_ingestion_timestamp"))


@query("snapshot_drivers")
def _snapshot_drivers(w: Warehouse) -> DataFrame:
    """Two snapshot runs: changed drivers get a new version, missing ones are closed."""
    first = driver_snapshot(None, _as_loaded(w, "session_key < 199800"), "1998-01-01 00:00:00")
    source = _as_loaded(w, "team_category <> 'Ferrari'")
    second = driver_snapshot(first, source, "2002-01-01 00:00:00")
    return second.select("driver_number", "team_name", "team_category", "valid_from", "valid_to")


@query("snapshot_sessions")
def _snapshot_sessions(w: Warehouse) -> DataFrame:
    rows = w.silver_sessions.withColumn("updated_at", F.col("_ingestion_timestamp"))
    first = session_snapshot(None, rows.filter("session_key < 200000"), "2000-01-01 00:00:00")
    later = rows.filter("session_key > 199700").withColumn(
        "updated_at", F.when(F.col("session_category") == "Race", F.lit("2001-09-01").cast("timestamp"))
        .otherwise(F.col("updated_at")),
    )
    second = session_snapshot(first, later, "2002-01-01 00:00:00")
    return second.select("session_key", "session_name", "valid_from", "valid_to")


@query("snapshot_tables")
def _snapshot_tables(w: Warehouse) -> DataFrame:
    """The runs of ``snapshot_drivers`` as tables, the second over the stored first."""
    spark = w.bronze_drivers.sparkSession
    path = fresh_path(spark, "snapshots")
    replace_table(w.silver_sessions, f"{path}/silver_sessions")
    replace_table(_as_loaded(w, "session_key < 199800"), f"{path}/silver_drivers")
    refresh_snapshots(spark, path, "1998-01-01 00:00:00")
    replace_table(_as_loaded(w, "team_category <> 'Ferrari'"), f"{path}/silver_drivers")
    refresh_snapshots(spark, path, "2002-01-01 00:00:00")
    return read_table(spark, f"{path}/driver_snapshot").select(
        "driver_number", "team_name", "team_category", "valid_from", "valid_to"
    )


def _history(w: Warehouse) -> DataFrame:
    return scd2_from_history(
        w.silver_drivers, "driver_number", ["team_name", "team_colour", "team_category"],
        "_ingestion_timestamp", ["session_key"],
    )


query("scd2_changes")(_history)
query("driver_history")(lambda w: reports.driver_history(_history(w)))


@query("asof_team")
def _asof_team(w: Warehouse) -> DataFrame:
    """Every lap with the team its driver had on that day."""
    laps = w.silver_laps.select(*silver.LAP_KEY, C.parse_time("date_start").alias("lap_time"))
    return asof_join(laps, _history(w), "driver_number", "lap_time").select(
        *silver.LAP_KEY, "team_name", "valid_from"
    )


def _spans(w: Warehouse) -> DataFrame:
    """Per session and driver the time from the first to 40 days after the last lap."""
    t = C.parse_time("date_start")
    return w.silver_laps.groupBy("session_key", "driver_number").agg(
        F.min(t).alias("valid_from"),
        F.timestamp_add("DAY", F.lit(40), F.max(t)).alias("valid_to"),
    )


query("version_overlaps")(
    lambda w: version_overlaps(_spans(w), "driver_number", "2002-01-01")
)
query("interval_errors")(
    lambda w: interval_order_errors(
        _history(w).withColumn("is_current", F.col("team_category") == "Ferrari")
    ).select("driver_number", "team_name", "valid_from", "valid_to", "issue")
)


# --- sessions, chunks -----------------------------------------------------------

SESSION_VIEW = ["session_key", "session_name", "session_type", "date_start", "year"]


def _sessions(name: str, **kwargs) -> None:
    query(name)(lambda w: select_sessions(w.silver_sessions, **kwargs).select(*SESSION_VIEW))


_sessions("select_latest", mode="latest", n=7)
_sessions("select_oldest", mode="oldest", n=7)
_sessions("select_year", mode="year", year=1998)
_sessions("select_days", mode="manual", days=["1997-03-01", "1999-10-01", "2000-12-01"])
query("recent_sessions")(
    lambda w: recent_sessions(w.silver_sessions, 1999, 5).select(*SESSION_VIEW)
)
query("race_sessions")(lambda w: race_sessions(w.silver_sessions, 2000, 10).select(*SESSION_VIEW))
query("stamp_children")(
    lambda w: stamp_children(
        w.bronze_laps.select("session_key", "driver_number", "lap_number", "session_name", "batch_day"),
        w.silver_sessions,
    )
)
query("chunk_plan")(lambda w: chunk_plan(w.event_sessions))
query("chunk_coverage")(lambda w: chunk_coverage(w.event_sessions, w.bronze_locations))
query("session_chunk_coverage")(
    lambda w: chunk_coverage(w.event_sessions, w.bronze_locations, by=())
)
query("chunk_points_open")(
    lambda w: points_in_chunks(w.bronze_locations, w.event_sessions, edges="open").select(
        "session_key", "driver_number", "date", "x", "y", "chunk"
    )
)


# --- ranks and column rules -----------------------------------------------------


def _ranked(w: Warehouse, ties: str, nulls: str) -> DataFrame:
    rows = w.silver_laps.select(*silver.LAP_KEY, "lap_duration")
    return ranks(
        rows, ["session_key"], "lap_duration", ties, ["driver_number", "lap_number"], nulls,
        "lap_rank",
    )


query("lap_rank_nulls_last")(lambda w: _ranked(w, "row_number", "last"))
query("lap_rank_shared")(lambda w: _ranked(w, "rank", "first"))
query("lap_rank_dense")(lambda w: _ranked(w, "dense_rank", "last"))
query("team_rank_nulls_last")(
    lambda w: build_team_performance(w.driver_session_summary, w.run_ts, "last").select(
        "session_key", "team_name", "team_fastest_lap", "team_rank"
    )
)
query("personal_best")(
    lambda w: with_group_value(
        w.silver_laps.select(*silver.LAP_KEY, "lap_duration", "is_valid_lap"),
        ["session_key", "driver_number"],
        F.min(F.when(F.col("is_valid_lap"), F.col("lap_duration"))), "best",
    )
)
query("masked_names")(
    lambda w: w.silver_drivers.select(
        "session_key", "driver_number", C.mask_tail("full_name").alias("masked"),
        C.surrogate_key("session_key", "driver_number", "full_name").alias("name_key"),
    )
)
query("mart_filters")(
    lambda w: w.session_leaderboard.filter(
        (F.col("session_category") == "Race")
        & F.col("team_name").like("%Red Bull%")
        & (F.col("position") <= 20)
    ).select("session_key", "driver_number", "team_name", "position", "fastest_lap_time")
)


# --- sources and sinks ----------------------------------------------------------

#: Rows at most in a landed file that is one JSON array.
ARRAY_ROWS = 5000
#: Landed lines are compressed, as JSON repeats its names in every row; rows at most in such a file.
LANDED = {"compression": "gzip", "file_rows": 1_000_000}
LINES = {"glob": "*.json*", "multi_line": False}
LAP_VIEW = ["session_key", "driver_number", "lap_number", "date_start", "lap_duration",
            "is_pit_out_lap", "i1_speed", "segments_sector_1", "batch_day"]


def _landed(w: Warehouse, table: str, **how: str | int) -> tuple[SparkSession, str]:
    """A bronze table as JSON files in a new landing folder."""
    df = w.table(table).drop("_ingestion_timestamp")
    path = fresh_path(df.sparkSession, "landing")
    export_json(df, path, stamp=False, **(how or LANDED))
    return df.sparkSession, path


@query("json_reload")
def _json_reload(w: Warehouse) -> DataFrame:
    spark, landing = _landed(w, "bronze_laps")
    return read_entity(spark, landing, "laps", **LINES).select(*LAP_VIEW)


@query("json_inferred")
def _json_inferred(w: Warehouse) -> DataFrame:
    """Read without a schema: the fields come from the files."""
    spark, landing = _landed(w, "bronze_drivers")
    return read_entity(spark, landing, "drivers", typed=False, **LINES).select(
        "session_key", "driver_number", "full_name", "team_name"
    )


@query("load_twice")
def _load_twice(w: Warehouse) -> DataFrame:
    """Array JSON in three loads: some files, the others and one without rows, and none."""
    df = w.bronze_sessions.drop("_ingestion_timestamp")
    spark = df.sparkSession
    landing, path = fresh_path(spark, "landing"), fresh_path(spark, "bronze")
    # A folder per group of sessions, in it files of one array with a bounded number of rows.
    part = F.coalesce(F.pmod("session_key", F.lit(8)), F.lit(0))
    file = F.floor(F.monotonically_increasing_id() / ARRAY_ROWS)
    arrays = df.withColumns({"part": part, "file": file}).groupBy("part", "file").agg(
        F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")
    ).drop("file")

    def land(rows: DataFrame) -> None:
        rows.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("part").text(landing)

    def load() -> int:
        return load_new_files(spark, landing, path, "sessions", max_files=3, glob="*.txt")

    land(arrays.filter("part < 4"))
    load()
    land(arrays.filter("part >= 4"))
    land(spark.range(1).select(F.lit(99).alias("part"), F.lit("[]").alias("value")))
    load()
    if load():
        raise RuntimeError("a loaded file was taken again")
    return read_table(spark, f"{path}/bronze_sessions").select(
        "session_key", "session_name", "date_start",
        F.regexp_extract("_source_file", "part=([0-9]+)", 1).alias("source_part"),
    )


@query("replace_twice")
def _replace_twice(w: Warehouse) -> DataFrame:
    """A table replaced by rows derived from itself."""
    df = w.silver_drivers.select("session_key", "driver_number", "team_name")
    spark = df.sparkSession
    path = replace_table(df, fresh_path(spark, "replaced"))
    replace_table(read_table(spark, path).filter("session_key % 2 = 0"), path)
    return read_table(spark, path)


@query("json_stamped")
def _json_stamped(w: Warehouse) -> DataFrame:
    df = w.silver_drivers.select("session_key", "driver_number")
    path = export_json(df, fresh_path(df.sparkSession, "stamped"))
    return df.sparkSession.read.json(path).select(
        "session_key", "driver_number", F.col("ingestion_timestamp").isNotNull().alias("stamped")
    )


@query("csv_reload")
def _csv_reload(w: Warehouse) -> DataFrame:
    df = w.bronze_laps.select(*LAP_VIEW)
    spark = df.sparkSession
    path = export_csv(df, fresh_path(spark, "csv"))
    text = df.withColumn("segments_sector_1", F.lit("")).schema
    return spark.read.schema(text).option("header", True).csv(path)


@query("partition_read")
def _partition_read(w: Warehouse) -> DataFrame:
    """One day of a table written by day; only its folder is read."""
    df = w.silver_laps
    path = write_table(df, fresh_path(df.sparkSession, "by-day"), partition_by=["batch_day"])
    rows = read_table(df.sparkSession, path).filter(F.col("batch_day") == "1998-05-01")
    return rows.select(*silver.LAP_KEY, "lap_duration", "batch_day")


@query("clustered_read")
def _clustered_read(w: Warehouse) -> DataFrame:
    """Laps of one session from files sorted by key, after compaction."""
    df = w.silver_laps.select(*silver.LAP_KEY, "lap_duration")
    spark = df.sparkSession
    path = write_table(df, fresh_path(spark, "clustered"), cluster_by=fv.LAYOUT_COLUMNS["laps"])
    packed = compact(
        read_table(spark, path), fresh_path(spark, "compact"), fv.LAYOUT_COLUMNS["laps"]
    )
    return read_table(spark, packed).filter(F.col("session_key") == 199805)


@query("append_new_columns")
def _append_new_columns(w: Warehouse) -> DataFrame:
    """Two loads of which the second has one more column."""
    df = w.bronze_drivers
    path = fresh_path(df.sparkSession, "evolving")
    cols = ["session_key", "driver_number", "team_name"]
    append_table(df.filter("session_key < 199800").select(*cols), path, "first")
    append_table(
        df.filter("session_key >= 199800").select(*cols, "country_code"), path, "second"
    )
    return read_table(df.sparkSession, path, evolving=True)


@query("table_counts")
def _table_counts(w: Warehouse) -> DataFrame:
    """Counts of named tables; one of them does not exist."""
    names = ["bronze_sessions", "bronze_drivers", "bronze_laps"]
    for name in names:
        w.table(name).createOrReplaceTempView(f"counted_{name}")
    spark = w.bronze_laps.sparkSession
    return count_tables(spark, [f"counted_{n}" for n in (*names, "bronze_weather")])


# --- streams --------------------------------------------------------------------


@query("stream_bronze")
def _stream_bronze(w: Warehouse) -> DataFrame:
    """Landed laps through a stream into a table, each row once."""
    spark, landing = _landed(w, "bronze_laps")
    target = fresh_path(spark, "stream")
    rows = stream_entity(spark, landing, "laps", **LINES)
    append_stream(rows, target, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(target).select(*LAP_VIEW)


@query("stream_quality")
def _stream_quality(w: Warehouse) -> DataFrame:
    """A second stream over the first one's table drops rows without keys."""
    spark, landing = _landed(w, "bronze_laps")
    raw, good = fresh_path(spark, "stream"), fresh_path(spark, "quality")
    rows = stream_entity(spark, landing, "laps", **LINES)
    append_stream(rows, raw, fresh_path(spark, "checkpoint")).awaitTermination()
    kept = laps_quality(chain_stream(spark, raw))
    append_stream(kept, good, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(good).select(*LAP_VIEW)


@query("stream_counts")
def _stream_counts(w: Warehouse) -> DataFrame:
    """The counts that a quality stream keeps per batch, added up."""
    spark, landing = _landed(w, "bronze_laps")
    raw = fresh_path(spark, "stream")
    rows = stream_entity(spark, landing, "laps", **LINES)
    append_stream(rows, raw, fresh_path(spark, "checkpoint")).awaitTermination()
    counts = fresh_path(spark, "counts")
    checked_stream(
        chain_stream(spark, raw), fresh_path(spark, "quality"), counts,
        fresh_path(spark, "checkpoint"), LAPS_DROP, LAPS_TRACK,
    ).awaitTermination()
    return spark.read.parquet(counts).groupBy("expectation").agg(
        F.sum("passed_records").alias("passed_records"),
        F.sum("failed_records").alias("failed_records"),
    )


@query("stream_evolving")
def _stream_evolving(w: Warehouse) -> DataFrame:
    """Landed locations through a stream that infers each batch."""
    spark, landing = _landed(w, "bronze_locations")
    target = fresh_path(spark, "evolving")
    evolving_stream(
        spark, landing, "locations", target, fresh_path(spark, "checkpoint"), **LINES
    ).awaitTermination()
    return read_table(spark, target, evolving=True).select(
        "session_key", "driver_number", "date", "x", "y", "z", "batch_day"
    )


query("expect_drop")(
    lambda w: locations_quality(w.bronze_locations).select(
        "session_key", "driver_number", "date", "x", "y", "z"
    )
)
query("expectation_counts")(
    lambda w: expectation_counts(w.bronze_laps, {**LAPS_DROP, **LAPS_TRACK})
)


# --- the same sources, catalogs and checks in further forms ------------------------------------


@query("json_mixed")
def _json_mixed(w: Warehouse) -> DataFrame:
    """Files that are one array beside files that are one record with a field of its own."""
    df = w.bronze_sessions.drop("_ingestion_timestamp")
    spark = df.sparkSession
    landing = fresh_path(spark, "landing")
    single = F.coalesce(F.pmod("session_key", F.lit(2)) == 1, F.lit(False))
    alone = df.filter(single).withColumn("shape", F.lit("record"))
    part = F.coalesce(F.pmod("session_key", F.lit(8)), F.lit(0))
    file = F.floor(F.monotonically_increasing_id() / ARRAY_ROWS)
    together = df.filter(~single).groupBy(part.alias("part"), file.alias("file")).agg(
        F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")
    )
    for rows in (together.select("value"), alone.select(F.to_json(F.struct(*alone.columns)).alias("value"))):
        rows.write.mode("append").option("maxRecordsPerFile", 1).text(landing)
    return read_json(spark, landing, glob="*.txt").select("session_key", "session_name", "shape")


@query("json_unknown_entity")
def _json_unknown_entity(w: Warehouse) -> DataFrame:
    """An entity without settings reads ``{entity}*.json``; Spark's own file names begin with part."""
    spark, landing = _landed(w, "bronze_drivers", compression="none")
    return read_entity(spark, landing, "part", typed=False, multi_line=False).select(
        "session_key", "driver_number", "name_acronym", "team_name"
    )


@query("stream_capped")
def _stream_capped(w: Warehouse) -> DataFrame:
    """Landed locations in batches of two files at most."""
    df = w.bronze_locations.drop("_ingestion_timestamp")
    spark = df.sparkSession
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "capped")
    export_json(df.repartition(7), landing, stamp=False)
    checked_stream(
        stream_entity(spark, landing, "locations", max_files_per_trigger=2, **LINES),
        target, fresh_path(spark, "counts"), fresh_path(spark, "checkpoint"), LOCATIONS_DROP, {},
    ).awaitTermination()
    rows = spark.read.parquet(target)
    files = rows.groupBy("batch").agg(F.count_distinct("_source_file").alias("files"))
    return rows.join(files, "batch").select(
        "session_key", "driver_number", "date", "x", "y", "z", (F.col("files") <= 2).alias("capped")
    )


@query("stream_interval")
def _stream_interval(w: Warehouse) -> DataFrame:
    """A run that goes on at an interval; it is stopped when all landed laps are in."""
    spark, landing = _landed(w, "bronze_laps")
    target = fresh_path(spark, "stream")
    running = append_stream(
        stream_entity(spark, landing, "laps", **LINES), target, fresh_path(spark, "checkpoint"),
        every="1 second",
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(target).select(*LAP_VIEW)


@query("catalog_tables")
def _catalog_tables(w: Warehouse) -> DataFrame:
    """A schema with two tables: what is in it, their columns, properties and rows."""
    spark = w.bronze_drivers.sparkSession
    schema = f"listed_{uuid.uuid4().hex}"
    create_schema(spark, schema)
    try:
        names = {e: f"{schema}.bronze_{e}" for e in ("sessions", "drivers")}
        for entity, name in names.items():
            save_table(
                w.table(f"bronze_{entity}"), name, table_comment(entity), table_properties(entity)
            )
        short = F.regexp_replace("table_name", "^.*[.]", "")
        parts = [
            list_tables(spark, schema).select(
                F.lit("table").alias("kind"), F.col("tableName").alias("name"), F.lit("").alias("value")
            ),
            describe_table(spark, names["drivers"]).filter("col_name LIKE '%number'").select(
                F.lit("column"), "col_name", "data_type"
            ),
            show_properties(spark, names["drivers"]).filter("key = 'quality'").select(
                F.lit("property"), "key", "value"
            ),
            count_tables(spark, list(names.values())).select(
                F.lit("rows"), short, F.col("record_count").cast("string")
            ),
        ]
        return stage(reduce(DataFrame.union, parts), "catalog")
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


@query("hot_mart")
def _hot_mart(w: Warehouse) -> DataFrame:
    """Two reports on a mart that is kept in memory meanwhile."""
    spark = w.bronze_laps.sparkSession
    name = f"hot_{uuid.uuid4().hex}"
    w.session_leaderboard.createOrReplaceTempView(name)
    mart = cache_table(spark, name)
    try:
        by_team = mart.groupBy(F.col("team_category").alias("name")).agg(
            F.count("*").alias("drivers"), F.min("fastest_lap_time").alias("fastest")
        )
        by_kind = mart.groupBy(F.col("session_category").alias("name")).agg(
            F.count("*").alias("drivers"), F.min("fastest_lap_time").alias("fastest")
        )
        return stage(by_team.unionByName(by_kind), "hot")
    finally:
        uncache_table(spark, name)
        spark.catalog.dropTempView(name)


@query("summary_mismatches_found")
def _summary_mismatches_found(w: Warehouse) -> DataFrame:
    """The check on laps of which some came twice after the summary was made."""
    laps = w.silver_laps
    twice = laps.unionByName(laps.filter("driver_number % 10 = 3"))
    return checks.summary_mismatches(w.driver_session_summary, twice)


@query("silver_duplicates_found")
def _silver_duplicates_found(w: Warehouse) -> DataFrame:
    """The report on tables in which some keys stand twice."""

    def twice(df: DataFrame) -> DataFrame:
        return df.unionByName(df.filter("session_key % 5 = 0"))

    return reports.silver_duplicates(Warehouse({
        "silver_sessions": lambda: twice(w.silver_sessions),
        "silver_drivers": lambda: twice(w.silver_drivers),
    }))


@query("distinct_united")
def _distinct_united(w: Warehouse) -> DataFrame:
    """Distinct counts of laps from sketches per day of two loads, beside the exact ones."""
    laps = w.silver_laps
    spark, path = laps.sparkSession, fresh_path(laps.sparkSession, "sketches")
    measures = {
        "sessions": ["session_key"], "drivers": ["driver_number"], "laps": silver.LAP_KEY,
        "speeds": ["max_speed"], "times": ["lap_duration"],
    }
    for name, part in (("first", "lap_number <= 5"), ("second", "lap_number > 5")):
        append_table(distinct_sketches(laps.filter(part), measures, ["batch_day"]), path, name)
    exact = laps.agg(*[F.count_distinct(*c).alias(n) for n, c in measures.items()])
    pairs = [x for n in measures for x in (F.lit(n), F.col(n))]
    exact = exact.select(F.explode(F.create_map(*pairs)).alias("measure", "exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.02 * F.col("exact")
    return united_counts(read_table(spark, path)).join(exact, "measure").select(
        "measure", "exact", near.alias("within_two_percent")
    )


@query("checks_merged")
def _checks_merged(w: Warehouse) -> DataFrame:
    """The silver checks from the states of two loads, whose laps come before half of their parents."""
    names = list(checks.SILVER_CHECKS)
    tables = {n: stage(w.table(n), n) for n in names}
    spark = w.bronze_laps.sparkSession
    path = fresh_path(spark, "states")
    early = {
        n: "session_key % 2 = 0" if n in ("silver_sessions", "silver_drivers") else "driver_number % 3 > 0"
        for n in names
    }
    for load, part in (("first", "coalesce({}, false)"), ("second", "NOT coalesce({}, false)")):
        brought = {n: df.filter(part.format(early[n])) for n, df in tables.items()}
        check_load(spark, brought, checks.SILVER_CHECKS, path, load)
    return merged_checks(spark, path, checks.SILVER_CHECKS)


@query("chunk_coverage_stream")
def _chunk_coverage_stream(w: Warehouse) -> DataFrame:
    """Chunk coverage from a stream of two landings; the second brings points that are too late."""
    points, sessions = w.bronze_locations.drop("_ingestion_timestamp"), w.event_sessions
    spark = points.sparkSession
    landing, target, state = (fresh_path(spark, x) for x in ("landing", "counts", "checkpoint"))
    late = "(driver_number % 7 = 0 AND date < '2024-01-10')"
    for part in (f"date < '2024-01-16' AND NOT coalesce({late}, false)", f"date >= '2024-01-16' OR {late}"):
        points.filter(part).write.mode("append").json(landing)
        stream = stream_entity(spark, landing, "locations", max_files_per_trigger=1000, **LINES)
        chunk_count_stream(stream, sessions, target, state).awaitTermination()
    counts = streamed_counts(spark, target)
    dropped = late_points(points, sessions, counts).select("session_key", "driver_number", "late")
    return coverage_of_counts(sessions, counts).join(dropped, ["session_key", "driver_number"])


@query("history_inserted")
def _history_inserted(w: Warehouse) -> DataFrame:
    """The team history from three loads whose times lie between each other."""
    rows = stage(w.silver_drivers, "drivers")
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "history")
    tracked = ["team_name", "team_colour", "team_category"]
    for part in ("session_key % 3 = 2", "session_key % 3 = 0", "session_key % 3 = 1 OR session_key IS NULL"):
        insert_history(path, rows.filter(part), "driver_number", tracked, "_ingestion_timestamp", ["session_key"])
    return read_history(spark, path)
