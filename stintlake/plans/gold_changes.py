"""Gold tables at rest, brought up to date where sessions changed.

Facts and marts lie in buckets of the session key. A load takes the silver lap files that no load took
before and touches the buckets of their sessions. Facts hold all columns of the laps that they
are made from, so old facts of a touched bucket and the new laps are all that is read; the rest of the silver
laps is not. Marts follow in the same buckets, and in those whose dimension rows changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators.grouping import join_same
from stintlake.plans import gold, marts
from stintlake.session import stage, staging
from stintlake.sources.batches import any_ended, merge_new_files
from stintlake.sources.parts import in_buckets, rewrite_buckets, rows_in, touched_buckets
from stintlake.sources.writers import (
    LOAD,
    current_version,
    read_table,
    remove,
    replace_table,
    table_exists,
)

#: Session buckets of facts and marts; fixed for a table, more for larger ones.
SESSION_BUCKETS = 32
KEY = ["session_key"]
BUCKETED = ("fact_laps", "driver_session_summary", "session_leaderboard", "team_performance")
DRIVER_COLUMNS = ["full_name", "team_name", "team_category", "is_current"]


#: What a rank adds to a lap; the other columns of a fact follow from its row.
RANKS = ["driver_lap_rank", "session_lap_time_rank", "driver_best_lap_time"]


def ranked_with(old: DataFrame | None, new: DataFrame, load: int) -> DataFrame:
    """Ranked laps of a bucket after a load; rows that a stopped run of the same load left are replaced.

    Ranks lie within a session, so old facts of sessions that the load does not bring stay as they are.
    """
    columns = [*gold.LAP_COLUMNS, "batch_day", "session_name", "updated_at"]
    laps = new.select(*columns, F.lit(load).alias(LOAD))
    if old is None:
        return gold.rank_laps(laps)
    # Folder names like 2024-03-02 are read as dates.
    stored = old.filter(F.col(LOAD) != load).withColumn("batch_day", F.col("batch_day").cast("string"))
    brought = stage(new.select(*KEY).distinct(), "brought")
    same = join_same(stored, brought, KEY, "left_semi").select(*laps.columns)
    ranked = gold.rank_laps(same.unionByName(laps))
    rest = join_same(stored, brought, KEY, "left_anti")
    return ranked.unionByName(rest.select(*laps.columns, *RANKS))


def changed_keys(new: DataFrame, old: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that only one side has, or whose columns differ."""
    after, before = (df.select(key, *columns) for df in (new, old))
    return after.exceptAll(before).unionByName(before.exceptAll(after)).select(key).distinct()


def _changed_by_dimensions(
    spark: SparkSession, path: str, sessions: DataFrame, drivers: DataFrame, buckets: int
) -> set[int]:
    """Buckets with sessions whose rows in a dimension, or those of their drivers, changed."""
    old = read_table(spark, f"{path}/dim_sessions")
    moved = changed_keys(sessions, old, "session_key", [*marts.SESSION_COLUMNS, "year"])
    touched = touched_buckets(moved, KEY, buckets)
    old = read_table(spark, f"{path}/dim_drivers")
    people = stage(changed_keys(drivers, old, "driver_number", DRIVER_COLUMNS), "changed-drivers")
    if people.isEmpty():
        return touched
    raced = read_table(spark, f"{path}/fact_laps").join(people, "driver_number", "left_semi")
    return touched | touched_buckets(raced, KEY, buckets)


def _refresh_marts(
    spark: SparkSession, path: str, touched: set[int], sessions: DataFrame, drivers: DataFrame,
    run_ts: str, fresh: bool, buckets: int,
) -> None:
    def rewrite(name: str, rows: DataFrame) -> None:
        rewrite_buckets(spark, f"{path}/{name}", touched, KEY, lambda old: rows, buckets, fresh)

    facts = rows_in(spark, f"{path}/fact_laps", touched, buckets)
    rewrite("driver_session_summary", marts.build_driver_session_summary(facts, sessions, drivers, run_ts))
    rewrite("session_leaderboard", marts.build_session_leaderboard(facts, sessions, drivers, run_ts))
    summary = rows_in(spark, f"{path}/driver_session_summary", touched, buckets)
    rewrite("team_performance", marts.build_team_performance(summary, run_ts))


def refresh_gold(
    spark: SparkSession, path: str, run_ts: str, full: bool = False, buckets: int = SESSION_BUCKETS
) -> None:
    """Bring dimensions, facts and marts up to the silver tables.

    Only buckets with changed sessions are written anew; the files of others stay. A stop at
    any point is made good by the next call: a load ends when its marts are written, a
    repeated one replaces its own rows, and dimensions are replaced last, so what they change is seen
    again. ``full``, a first call and silver laps that were rebuilt make everything anew. A load time
    column of a mart row tells when its bucket was written.
    """
    source, facts = f"{path}/silver_laps", f"{path}/fact_laps"
    version = (current_version(spark, source) or "first").rsplit("/", 1)[-1]
    log = f"{path}/_loads/fact_laps-{version}"
    known = table_exists(spark, f"{path}/dim_sessions") and table_exists(spark, f"{path}/dim_drivers")
    kept = known and all(in_buckets(spark, f"{path}/{n}", buckets) for n in BUCKETED)
    fresh = full or not kept or not any_ended(spark, log)
    if fresh:
        remove(spark, log)
    with staging(spark):
        sessions = stage(gold.build_dim_sessions(read_table(spark, f"{path}/silver_sessions")), "dim-sessions")
        drivers = stage(gold.build_dim_drivers(read_table(spark, f"{path}/silver_drivers")), "dim-drivers")
        waiting = set() if fresh else _changed_by_dimensions(spark, path, sessions, drivers, buckets)

        def follow(touched: set[int]) -> None:
            _refresh_marts(spark, path, touched, sessions, drivers, run_ts, fresh, buckets)

        def merge(new: DataFrame, load: int) -> None:
            touched = touched_buckets(new, KEY, buckets)
            rewrite_buckets(
                spark, facts, touched, KEY, lambda old: ranked_with(old, new, load), buckets, fresh,
                ["batch_day"], finish=lambda rows: gold.with_lap_keys(rows, [LOAD]),
            )
            follow(touched | waiting)

        if not merge_new_files(spark, source, log, merge) and waiting:
            follow(waiting)
        replace_table(sessions, f"{path}/dim_sessions")
        replace_table(drivers, f"{path}/dim_drivers")
