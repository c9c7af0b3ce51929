"""Marts: per driver and session, per session ranking, per team and session.

Laps are aggregated to (session, driver) before any join. Both dimensions are
unique on their join keys, so the result is that of joining first, while the
joins and ranks see one row per driver and session instead of every lap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stintlake.functions import columns as C
from stintlake.plans.silver import run_time

SESSION_COLUMNS = ["session_name", "session_category", "location", "session_date"]


def current_drivers(dim_drivers: DataFrame) -> DataFrame:
    return dim_drivers.filter("is_current").select(
        "driver_number", F.col("full_name").alias("driver_name"), "team_name", "team_category"
    )


def lap_stats(fact_laps: DataFrame) -> DataFrame:
    """Lap counts, times, sectors and speeds per session and driver."""
    valid = F.col("is_valid_lap")
    time = F.when(valid, F.col("lap_duration"))
    sector = {n: F.when(valid, F.col(f"duration_sector_{n}")) for n in (1, 2, 3)}
    return fact_laps.groupBy("session_key", "driver_number").agg(
        F.count("*").alias("total_laps"),
        F.count_if(valid).alias("valid_laps"),
        F.count_if("is_pit_out_lap").alias("pit_out_laps"),
        F.min(time).alias("fastest"),
        F.max(time).alias("slowest"),
        C.mean(time).alias("average"),
        F.stddev_samp(time).alias("spread"),
        *[C.mean(s).alias(f"avg_sector_{n}") for n, s in sector.items()],
        *[F.min(s).alias(f"best_sector_{n}") for n, s in sector.items()],
        F.max("max_speed").alias("top_speed"),
        F.avg(F.when(valid, F.col("max_speed"))).alias("speed"),
        F.count_if(F.col("sector_completeness") == "Complete").alias("complete_sector_laps"),
    )


def build_driver_session_summary(
    fact_laps: DataFrame, dim_sessions: DataFrame, dim_drivers: DataFrame, run_ts: str | None = None
) -> DataFrame:
    """One row per session and driver known to both dimensions."""
    stats = lap_stats(fact_laps).withColumn("session_dim_key", C.surrogate_key("session_key"))
    rows = stats.join(
        dim_sessions.select("session_dim_key", *SESSION_COLUMNS), "session_dim_key"
    ).join(current_drivers(dim_drivers), "driver_number")
    return rows.select(
        C.surrogate_key("session_key", "driver_number").alias("summary_key"),
        "session_dim_key",
        C.surrogate_key("driver_number").alias("driver_key"),
        "session_key", "driver_number", "driver_name", "team_name", "team_category",
        *SESSION_COLUMNS,
        "total_laps", "valid_laps", "pit_out_laps",
        C.percent("valid_laps", "total_laps").alias("valid_lap_percentage"),
        F.round("fastest", 3).alias("fastest_lap_time"),
        F.round("slowest", 3).alias("slowest_lap_time"),
        F.round("average", 3).alias("avg_lap_time"),
        F.round("spread", 3).alias("lap_time_stddev"),
        F.round(F.col("slowest") - F.col("fastest"), 3).alias("lap_time_range"),
        *[F.round(f"avg_sector_{n}", 3).alias(f"avg_sector_{n}_time") for n in (1, 2, 3)],
        *[F.round(f"best_sector_{n}", 3).alias(f"best_sector_{n}_time") for n in (1, 2, 3)],
        F.round(C.sum_or_zero("best_sector_1", "best_sector_2", "best_sector_3"), 3).alias(
            "theoretical_best_lap"
        ),
        "top_speed",
        F.round("speed", 1).alias("avg_speed"),
        "complete_sector_laps",
        F.round(C.ratio("spread", "average"), 4).alias("consistency_coefficient"),
        run_time(run_ts).alias("created_at"),
    )


def fastest_laps(fact_laps: DataFrame) -> DataFrame:
    """Best valid time per session and driver; drivers without one are left out.

    ``fastest_lap_number`` is the first valid lap, as in the model it follows;
    ``lap_of_fastest`` is the first lap on which the best time was driven.
    """
    valid = F.col("is_valid_lap")
    best = valid & (F.col("lap_duration") == F.col("driver_best_lap_time"))
    return (
        fact_laps.groupBy("session_key", "driver_number")
        .agg(
            F.min(F.when(valid, F.col("lap_duration"))).alias("fastest"),
            F.min(F.when(valid, F.col("lap_number"))).alias("fastest_lap_number"),
            F.min(F.when(best, F.col("lap_number"))).alias("lap_of_fastest"),
        )
        .filter("fastest IS NOT NULL")
    )


def rank_positions(rows: DataFrame, measure: str) -> DataFrame:
    """Add overall and team positions and the best value of each session.

    A session lists a driver once, so its rows are bounded by the driver dimension, and one
    shuffle by session serves all three columns.
    """
    order = [F.col(measure), F.col("driver_number")]
    in_session = Window.partitionBy("session_key")
    in_team = Window.partitionBy("session_key", "team_category")
    return rows.select(
        "*",
        F.row_number().over(in_session.orderBy(*order)).cast("long").alias("position"),
        F.row_number().over(in_team.orderBy(*order)).cast("long").alias("team_position"),
        F.min(measure).over(in_session).alias("session_best"),
    )


def build_session_leaderboard(
    fact_laps: DataFrame,
    dim_sessions: DataFrame,
    dim_drivers: DataFrame,
    run_ts: str | None = None,
) -> DataFrame:
    """Drivers of each session by fastest valid lap, equal times by driver number."""
    drivers = current_drivers(dim_drivers)
    rows = (
        fastest_laps(fact_laps)
        .join(dim_sessions.select("session_key", *SESSION_COLUMNS, "year"), "session_key")
        .join(drivers, "driver_number")
    )
    rows = rank_positions(rows, "fastest")
    gap = F.col("fastest") - F.col("session_best")
    return rows.select(
        C.surrogate_key("session_key", "driver_number").alias("leaderboard_key"),
        C.surrogate_key("session_key").alias("session_dim_key"),
        C.surrogate_key("driver_number").alias("driver_key"),
        "session_key", "driver_number", "driver_name", "team_name", "team_category",
        *SESSION_COLUMNS, "year", "position", "team_position",
        F.round("fastest", 3).alias("fastest_lap_time"),
        "fastest_lap_number", "lap_of_fastest",
        F.round(gap, 3).alias("delta_to_fastest"),
        F.round(gap / F.col("session_best") * 100, 2).alias("gap_percentage"),
        (F.col("position") == 1).alias("is_fastest"),
        (F.col("position") <= 3).alias("is_top_3"),
        (F.col("position") <= 10).alias("is_top_10"),
        (F.col("team_position") == 1).alias("is_fastest_in_team"),
        run_time(run_ts).alias("created_at"),
    )


def build_team_performance(
    summary: DataFrame, run_ts: str | None = None, nulls: str = "first"
) -> DataFrame:
    """Teams of each session by their fastest lap; a team without one ranks first
    unless ``nulls="last"``.

    Teams are the fixed categories, so a session has at most a dozen rows to rank.
    """
    stats = summary.groupBy("session_key", "team_category", *SESSION_COLUMNS).agg(
        # One summary row per driver and session: the rows are the distinct drivers.
        F.count("driver_number").alias("drivers_count"),
        F.sum("total_laps").alias("team_total_laps"),
        F.sum("valid_laps").alias("team_valid_laps"),
        F.min("fastest_lap_time").alias("fastest"),
        C.mean("fastest_lap_time").alias("avg_fastest"),
        F.max("top_speed").alias("team_top_speed"),
        F.avg("top_speed").alias("avg_top_speed"),
        C.mean("consistency_coefficient").alias("avg_consistency"),
        C.mean("lap_time_stddev").alias("avg_spread"),
    )
    best = F.col("fastest")
    order = best.asc_nulls_first() if nulls == "first" else best.asc_nulls_last()
    rank = F.row_number().over(
        Window.partitionBy("session_key").orderBy(order, "team_category")
    )
    return stats.select(
        C.surrogate_key("session_key", "team_category").alias("team_performance_key"),
        C.surrogate_key("session_key").alias("session_dim_key"),
        "session_key",
        F.col("team_category").alias("team_name"),
        *SESSION_COLUMNS,
        "drivers_count", "team_total_laps", "team_valid_laps",
        C.percent("team_valid_laps", "team_total_laps").alias("team_valid_lap_percentage"),
        F.round("fastest", 3).alias("team_fastest_lap"),
        F.round("avg_fastest", 3).alias("team_avg_fastest_lap"),
        F.round(F.col("avg_fastest") - F.col("fastest"), 3).alias("intra_team_gap"),
        "team_top_speed",
        F.round("avg_top_speed", 1).alias("team_avg_top_speed"),
        F.round("avg_consistency", 4).alias("team_avg_consistency"),
        F.round("avg_spread", 3).alias("team_avg_lap_stddev"),
        rank.cast("long").alias("team_rank"),
        run_time(run_ts).alias("created_at"),
    )
