"""Silver layer: cleaned rows of the four bronze tables.

Every builder is a function of DataFrames. ``run_ts`` stamps ``updated_at``, so
a run can be repeated with equal results; NULL means the current time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv
from stintlake.operators.dedupe import latest_per_key, require

SESSION_KEY = ["session_key"]
DRIVER_KEY = ["session_key", "driver_number"]
LAP_KEY = ["session_key", "driver_number", "lap_number"]
LOCATION_KEY = ["session_key", "driver_number", "date"]

SESSION_UPDATES = ["session_name", "location", "country_name", "updated_at"]
DRIVER_UPDATES = ["team_name", "team_colour", "updated_at"]

NEWEST = "_ingestion_timestamp"


def run_time(run_ts: str | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def build_silver_sessions(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per session: the last one ingested, ties by name, type, start and end."""
    rows = latest_per_key(
        require(bronze, SESSION_KEY),
        SESSION_KEY,
        [F.col(NEWEST).desc_nulls_last()],
        ["session_name", "session_type", "date_start", "date_end"],
    )
    return rows.select(
        "session_key",
        F.coalesce("session_name", F.lit(fv.UNKNOWN)).alias("session_name"),
        F.coalesce("session_type", "session_name").alias("session_type"),
        "date_start",
        "date_end",
        "gmt_offset",
        "meeting_key",
        F.coalesce("location", F.lit(fv.UNKNOWN)).alias("location"),
        "country_key",
        "country_code",
        F.coalesce("country_name", F.lit(fv.UNKNOWN)).alias("country_name"),
        "circuit_key",
        "circuit_short_name",
        "year",
        C.minutes_between("date_start", "date_end").alias("session_duration_minutes"),
        C.session_category("session_name").alias("session_category"),
        NEWEST,
        run_time(run_ts).alias("updated_at"),
    )


def build_silver_drivers(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per session and driver, names and team filled in.

    The category follows the raw team name, so a missing team is ``Other``.
    """
    rows = latest_per_key(
        require(bronze, DRIVER_KEY),
        DRIVER_KEY,
        [F.col(NEWEST).desc_nulls_last()],
        ["team_name", "team_colour", "full_name", "broadcast_name"],
    )
    first_last = F.concat("first_name", F.lit(" "), "last_name")
    return rows.select(
        "session_key",
        "meeting_key",
        "driver_number",
        F.coalesce("broadcast_name", "full_name", first_last).alias("broadcast_name"),
        F.coalesce("full_name", "broadcast_name").alias("full_name"),
        "name_acronym",
        F.coalesce("team_name", F.lit(fv.UNKNOWN_TEAM)).alias("team_name"),
        F.coalesce("team_colour", F.lit(fv.NO_COLOUR)).alias("team_colour"),
        "first_name",
        "last_name",
        "headshot_url",
        "country_code",
        C.team_category("team_name").alias("team_category"),
        NEWEST,
        run_time(run_ts).alias("updated_at"),
    )


def build_silver_laps(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Laps with complete keys, validity, sector checks and top speed. No shuffle."""
    sectors = ["duration_sector_1", "duration_sector_2", "duration_sector_3"]
    speeds = ["i1_speed", "i2_speed", "st_speed"]
    total = C.sum_or_zero(*sectors)
    return require(bronze, LAP_KEY).select(
        "session_key",
        "meeting_key",
        "driver_number",
        "lap_number",
        "date_start",
        "lap_duration",
        F.coalesce("is_pit_out_lap", F.lit(False)).alias("is_pit_out_lap"),
        *sectors,
        F.col("i1_speed").alias("intermediate_1_speed"),
        F.col("i2_speed").alias("intermediate_2_speed"),
        F.col("st_speed").alias("speed_trap_speed"),
        "segments_sector_1",
        "segments_sector_2",
        "segments_sector_3",
        total.alias("calculated_lap_duration"),
        (F.col("lap_duration") - total).alias("sector_duration_delta"),
        C.is_valid_lap("lap_duration", "is_pit_out_lap").alias("is_valid_lap"),
        C.sector_completeness(*sectors).alias("sector_completeness"),
        F.greatest(*[C.zero_if_null(s) for s in speeds]).alias("max_speed"),
        "batch_day",
        "session_name",
        NEWEST,
        run_time(run_ts).alias("updated_at"),
    )


def build_silver_locations(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Positions with complete keys and coordinates. No shuffle."""
    return require(bronze, [*LOCATION_KEY, "x", "y"]).select(
        "session_key",
        "meeting_key",
        "driver_number",
        "date",
        F.col("x").alias("position_x"),
        F.col("y").alias("position_y"),
        C.zero_if_null("z").alias("position_z"),
        C.planar_distance("x", "y").alias("distance_from_origin"),
        "batch_day",
        "session_name",
        NEWEST,
        run_time(run_ts).alias("updated_at"),
    )
