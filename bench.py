"""Time the pipeline, the models and the reports; prints one JSON line.

``BENCH_SF_DIR`` names the data set, ``BENCH_CPUS`` the local cores. Three kinds of times:

- ``load_*``, ``build_*``: landing files to bronze, then silver, gold and marts as tables.
  ``load_bronze_arrays`` loads all four entities from JSON arrays, as an extractor lands them;
- ``gold_*``: reports over those tables at rest, as an analyst would run them;
- the other names: registered queries that start from the given tables every time.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.plans import build, reports
from stintlake.plans.registry import QUERIES, RUN_TS
from stintlake.plans.warehouse import Warehouse
from stintlake.session import fresh_path, local_session
from stintlake.sources.writers import export_json, write_table
from stintlake.streaming.ingest import append_stream, stream_entity

MODELS = [
    "silver_sessions", "silver_drivers", "silver_laps", "silver_locations", "dim_sessions",
    "dim_drivers", "fact_laps", "driver_session_summary", "session_leaderboard",
    "team_performance",
]
OPERATORS = [
    "star_join_top_laps", "orphaned_laps", "sessions_missing_drivers", "version_overlaps",
    "asof_team", "bronze_to_silver", "latest_leaderboard", "reconcile_bronze", "lap_distribution",
    "drivers_by_team", "duplicate_sessions", "driver_season_stats", "team_battle",
    "personal_best", "lap_rank_shared", "position_steps", "hwm_read", "merge_partial",
    "append_dedupe", "snapshot_drivers", "scd2_changes", "chunk_coverage", "dq_silver", "dq_core",
    "all_layer_health", "partition_read", "json_reload", "stream_bronze",
]
GOLD = [
    "all_layer_health", "top_ten_per_session", "race_team_ranking", "lap_stats_by_session",
    "star_join_top_laps", "top_performers", "driver_season_stats", "unreasonable_laps",
    "silver_gold_lineage", "fact_laps_profile",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"), "stintlake-bench", spark__ui__showConsoleProgress="false"
    )
    times: dict[str, float] = {}

    def timed(name: str, step: Callable[[], object]) -> None:
        start = time.perf_counter()
        step()
        times[name] = round(time.perf_counter() - start, 3)

    run(QUERIES["silver_sessions"](spark, sf_dir))  # starts the session

    source = Warehouse.over_tables(spark, sf_dir, RUN_TS)
    path = fresh_path(spark, "bench")
    landing = fresh_path(spark, "landing")
    export_json(source.bronze_locations.drop("_ingestion_timestamp"), landing, stamp=False)
    locations = spark.read.json(landing).count()
    timed("load_locations_stream", lambda: append_stream(
        stream_entity(spark, landing, "locations", glob="*.json", multi_line=False),
        f"{path}/stream", f"{path}/checkpoint",
    ).awaitTermination())

    entities = ("sessions", "drivers", "laps", "locations")
    arrays = fresh_path(spark, "arrays")
    for entity in entities:
        df = source.table(f"bronze_{entity}").drop("_ingestion_timestamp")
        files = -(-df.count() // 5000)
        dealt = df.withColumn("part", F.pmod(F.xxhash64("session_key", "driver_number")
                              if "driver_number" in df.columns else F.xxhash64("session_key"),
                              F.lit(files)))
        dealt.groupBy("part").agg(
            F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")
        ).write.partitionBy("part").text(f"{arrays}/{entity}")

    def landed() -> None:
        for entity in entities:
            build.load_new_files(spark, f"{arrays}/{entity}", f"{path}/landed", entity, glob="*.txt")

    timed("load_bronze_arrays", landed)

    def bronze() -> None:
        for name in ("bronze_sessions", "bronze_drivers", "bronze_laps", "bronze_locations"):
            write_table(source.table(name), f"{path}/{name}")

    timed("build_bronze", bronze)
    timed("build_silver", lambda: build.refresh_silver(spark, path, RUN_TS, full=True))
    timed("build_gold_and_marts", lambda: build.refresh_gold(spark, path, RUN_TS))

    for name in GOLD:
        tables = Warehouse.at_path(spark, path)
        timed(f"gold_{name}", lambda: run(getattr(reports, name)(tables)))
    for name in MODELS + OPERATORS:
        timed(name, lambda: run(QUERIES[name](spark, sf_dir)))

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "location_rows_per_second": round(locations / times["load_locations_stream"]),
    }))


if __name__ == "__main__":
    main()
