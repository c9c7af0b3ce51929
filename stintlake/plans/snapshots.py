"""Snapshot tables of drivers and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stintlake.operators.scd import snapshot
from stintlake.plans.gold import DRIVER_ATTRIBUTES

SESSION_ATTRIBUTES = [
    "session_name", "session_type", "session_category", "date_start", "date_end",
    "session_duration_minutes", "gmt_offset", "meeting_key", "location", "country_key",
    "country_code", "country_name", "circuit_key", "circuit_short_name", "year",
]


def driver_snapshot(
    current: DataFrame | None, silver_drivers: DataFrame, run_ts: str
) -> DataFrame:
    """Silver has a row per session and driver; the newest row of a driver counts."""
    rows = silver_drivers.select("driver_number", *DRIVER_ATTRIBUTES, "updated_at")
    return snapshot(
        current, rows, "driver_number", "updated_at", run_ts, tie_break=["team_name", "full_name"]
    )


def session_snapshot(
    current: DataFrame | None, silver_sessions: DataFrame, run_ts: str
) -> DataFrame:
    rows = silver_sessions.select("session_key", *SESSION_ATTRIBUTES, "updated_at")
    return snapshot(current, rows, "session_key", "updated_at", run_ts)
