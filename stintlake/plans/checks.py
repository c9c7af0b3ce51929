"""The declared checks of every table, and the checks across tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.operators.dedupe import duplicate_keys
from stintlake.operators.grouping import row_numbers, with_previous
from stintlake.operators.profile import reconcile
from stintlake.operators.quality import (
    accepted,
    expression,
    implies,
    not_null,
    relationship,
    unique,
)

# Accepted categories and flags.
SESSION_VALUES = ["Race", "Qualifying", "Practice", "Sprint", "Other"]
TEAM_VALUES = [
    "Red Bull Racing", "Ferrari", "Mercedes", "McLaren", "Alpine", "Aston Martin", "Williams",
    "AlphaTauri", "AlphaTauri/RB", "RB", "Alfa Romeo", "Alfa Romeo/Sauber", "Sauber",
    "Haas F1 Team", "Haas", "Other",
]
FLAGS = [True, False]

# The declared checks.
BRONZE_CHECKS = {
    "bronze_sessions": [not_null("session_key"), unique("session_key", "session_key")],
    "bronze_drivers": [not_null("session_key"), not_null("driver_number")],
    "bronze_laps": [not_null("session_key"), not_null("driver_number"), not_null("lap_number")],
    "bronze_locations": [
        not_null("session_key"), not_null("driver_number"), not_null("date"), not_null("x"),
        not_null("y"),
    ],
}

SILVER_CHECKS = {
    "silver_sessions": [
        not_null("session_key"),
        unique("session_key", "session_key"),
        not_null("session_name"),
        accepted("session_category", SESSION_VALUES),
        not_null("location"),
        not_null("year"),
        expression("session_duration_not_negative", "session_duration_minutes >= 0",
                   "session_duration_minutes IS NOT NULL"),
        not_null("updated_at"),
    ],
    "silver_drivers": [
        not_null("session_key"),
        not_null("driver_number"),
        not_null("full_name"),
        not_null("team_name"),
        not_null("team_category"),
        accepted("team_category", TEAM_VALUES, "warn"),
        not_null("updated_at"),
        unique("session_driver", "session_key || '-' || driver_number"),
        expression("valid_driver_number_range", "driver_number > 0 AND driver_number < 100"),
    ],
    "silver_laps": [
        not_null("session_key"),
        not_null("driver_number"),
        not_null("lap_number"),
        expression("lap_duration_positive", "lap_duration > 0",
                   "lap_duration IS NOT NULL AND is_valid_lap = TRUE"),
        expression("lap_duration_reasonable", "lap_duration < 300",
                   "lap_duration IS NOT NULL", "warn"),
        not_null("is_valid_lap"),
        accepted("is_valid_lap", FLAGS),
        accepted("sector_completeness", ["Complete", "Partial", "No Sectors"]),
        expression("max_speed_positive", "max_speed > 0", "max_speed IS NOT NULL", "warn"),
        expression("max_speed_reasonable", "max_speed < 400", "max_speed IS NOT NULL"),
        not_null("updated_at"),
        unique("session_driver_lap", "session_key || '-' || driver_number || '-' || lap_number"),
        expression("positive_lap_numbers", "lap_number > 0"),
    ],
    "silver_locations": [
        not_null("session_key"),
        not_null("driver_number"),
        not_null("date"),
        not_null("position_x"),
        not_null("position_y"),
        expression("distance_not_negative", "distance_from_origin >= 0",
                   "distance_from_origin IS NOT NULL"),
        not_null("updated_at"),
    ],
}

CORE_CHECKS = {
    "dim_drivers": [
        not_null("driver_key"),
        unique("driver_key", "driver_key"),
        not_null("driver_number"),
        unique("driver_number", "driver_number"),
        not_null("full_name"),
        not_null("team_name"),
        not_null("is_current"),
        accepted("is_current", FLAGS),
        not_null("valid_from"),
    ],
    "dim_sessions": [
        not_null("session_dim_key"),
        unique("session_dim_key", "session_dim_key"),
        not_null("session_key"),
        unique("session_key", "session_key"),
        not_null("session_category"),
        accepted("session_category", SESSION_VALUES),
        not_null("is_race"),
        accepted("is_race", FLAGS),
        accepted("is_qualifying", FLAGS),
        accepted("is_practice", FLAGS),
        not_null("session_year"),
        expression("reasonable_session_year",
                   "session_year >= 2020 AND session_year <= YEAR(CURRENT_DATE)"),
    ],
    "fact_laps": [
        not_null("lap_key"),
        unique("lap_key", "lap_key"),
        not_null("session_dim_key"),
        relationship("session_dim_key", "dim_sessions", "session_dim_key"),
        not_null("driver_key"),
        relationship("driver_key", "dim_drivers", "driver_key"),
        expression("lap_duration_positive", "lap_duration > 0",
                   "lap_duration IS NOT NULL AND is_valid_lap = TRUE"),
        not_null("is_valid_lap"),
        accepted("is_valid_lap", FLAGS),
        not_null("is_personal_best_lap"),
        accepted("is_personal_best_lap", FLAGS),
        expression("session_lap_time_rank_positive", "session_lap_time_rank > 0",
                   "session_lap_time_rank IS NOT NULL"),
    ],
}

MART_CHECKS = {
    "driver_session_summary": [
        not_null("summary_key"),
        unique("summary_key", "summary_key"),
        not_null("driver_name"),
        not_null("team_name"),
        not_null("total_laps"),
        not_null("valid_laps"),
        expression("consistency_not_negative", "consistency_coefficient >= 0",
                   "consistency_coefficient IS NOT NULL"),
        expression("valid_laps_not_exceed_total", "valid_laps <= total_laps"),
        expression("theoretical_best_faster_than_actual",
                   "theoretical_best_lap <= fastest_lap_time",
                   "theoretical_best_lap IS NOT NULL AND fastest_lap_time IS NOT NULL"),
    ],
    "session_leaderboard": [
        not_null("leaderboard_key"),
        unique("leaderboard_key", "leaderboard_key"),
        not_null("position"),
        not_null("fastest_lap_time"),
        not_null("delta_to_fastest"),
        not_null("gap_percentage"),
        accepted("is_top_3", FLAGS),
        expression("positive_position", "position > 0"),
        expression("non_negative_delta", "delta_to_fastest >= 0"),
        expression("non_negative_gap_percentage", "gap_percentage >= 0"),
        implies("position_1_is_fastest", "position = 1", "is_fastest = TRUE"),
        implies("top_3_position_flag_consistent", "position <= 3", "is_top_3 = TRUE"),
    ],
    "team_performance": [
        not_null("team_performance_key"),
        unique("team_performance_key", "team_performance_key"),
        not_null("team_name"),
        not_null("drivers_count"),
        not_null("team_fastest_lap"),
        not_null("team_rank"),
        expression("positive_driver_count", "drivers_count > 0"),
        expression("positive_fastest_lap", "team_fastest_lap > 0"),
        expression("positive_team_rank", "team_rank > 0"),
        expression("non_negative_intra_team_gap", "intra_team_gap >= 0",
                   "intra_team_gap IS NOT NULL"),
    ],
}

ALL_CHECKS = {**BRONZE_CHECKS, **SILVER_CHECKS, **CORE_CHECKS, **MART_CHECKS}


# --- checks across tables: no rows means good ---------------------------------


def orphaned_laps(laps: DataFrame, drivers: DataFrame, sessions: DataFrame) -> DataFrame:
    """Driver-sessions with laps but without driver or session row."""
    keys = ["session_key", "driver_number"]
    seen = laps.select(*keys).distinct()
    no_driver = seen.join(drivers.select(*keys), keys, "left_anti")
    no_session = seen.join(sessions.select("session_key"), "session_key", "left_anti")
    return no_driver.withColumn("issue", F.lit("Missing driver record")).unionByName(
        no_session.withColumn("issue", F.lit("Missing session record"))
    )


def summary_mismatches(summary: DataFrame, laps: DataFrame) -> DataFrame:
    """Summaries whose lap counts differ from the laps themselves."""
    keys = ["session_key", "driver_number"]
    actual = laps.groupBy(*keys).agg(
        F.count("*").alias("actual_total_laps"),
        F.count_if("is_valid_lap").alias("actual_valid_laps"),
    )
    stored = summary.select(
        *keys, F.col("total_laps").alias("summary_total"), F.col("valid_laps").alias("summary_valid")
    )
    pairs = [("summary_total", "actual_total_laps"), ("summary_valid", "actual_valid_laps")]
    return reconcile(stored, actual, keys, pairs)


def fastest_lap_mismatches(leaderboard: DataFrame, fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Sessions whose first position is not the fastest valid lap, beyond 0.01 s."""
    stored = leaderboard.filter("position = 1").select(
        "session_key", F.col("fastest_lap_time").alias("leaderboard_fastest")
    )
    actual = (
        fact.filter("is_valid_lap AND lap_duration IS NOT NULL")
        .groupBy("session_key")
        .agg(F.min("lap_duration").alias("fact_fastest"))
        .join(dim.select("session_key"), "session_key", "left_semi")
    )
    pairs = [("leaderboard_fastest", "fact_fastest")]
    return reconcile(stored, actual, ["session_key"], pairs, tolerance=0.01).withColumn(
        "difference", F.abs(F.col("leaderboard_fastest") - F.col("fact_fastest"))
    )


def position_gaps(leaderboard: DataFrame) -> DataFrame:
    """Positions that are not 1, 2, 3, ... within their session, which lists a driver once."""
    rows = leaderboard.select("session_key", "position")
    numbered = row_numbers(rows, ["session_key"], [F.col("position")], "expected_position")
    return numbered.filter("position <> expected_position").select(
        "session_key", F.col("position").alias("actual_position"), "expected_position",
        F.lit("Position gap detected").alias("issue"),
    )


def position_steps(leaderboard: DataFrame) -> DataFrame:
    """Positions that do not follow the preceding one of their session."""
    rows = with_previous(
        leaderboard.select("session_key", "position"), ["session_key"], ["position"],
        {"prev_position": "position"},
    )
    return rows.filter(F.col("position") != F.coalesce(F.col("prev_position") + 1, F.lit(1)))


def team_count_mismatches(teams: DataFrame, drivers: DataFrame) -> DataFrame:
    """Teams whose reported drivers differ from the session's driver list.

    Both sides are compared by category; raw team names would match few of them.
    """
    actual = (
        drivers.groupBy("session_key", F.col("team_category").alias("team_name"))
        .agg(F.count_distinct("driver_number").alias("actual_count"))
    )
    stored = teams.select(
        "session_key", "team_name", F.col("drivers_count").alias("reported_count")
    )
    pairs = [("reported_count", "actual_count")]
    return reconcile(stored, actual, ["session_key", "team_name"], pairs).withColumn(
        "difference", F.col("reported_count") - F.col("actual_count")
    )


def not_one_current(dim_drivers: DataFrame) -> DataFrame:
    """Drivers that do not have exactly one current row."""
    counts = dim_drivers.groupBy("driver_number").agg(
        F.count_if("is_current").alias("current_count")
    )
    return counts.filter("current_count <> 1")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys)
