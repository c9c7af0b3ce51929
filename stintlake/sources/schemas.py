"""Landing schemas. Every field may be NULL; identifiers are BIGINT."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Columns and types of the four landing entities.
DDL = {
    "sessions": """
        session_key BIGINT, session_name STRING, date_start STRING, date_end STRING,
        gmt_offset STRING, session_type STRING, meeting_key BIGINT, location STRING,
        country_key BIGINT, country_code STRING, country_name STRING, circuit_key BIGINT,
        circuit_short_name STRING, year INT""",
    "drivers": """
        session_key BIGINT, meeting_key BIGINT, driver_number BIGINT, broadcast_name STRING,
        full_name STRING, name_acronym STRING, team_name STRING, team_colour STRING,
        first_name STRING, last_name STRING, headshot_url STRING, country_code STRING""",
    "laps": """
        session_key BIGINT, meeting_key BIGINT, driver_number BIGINT, lap_number BIGINT,
        date_start STRING, lap_duration DOUBLE, is_pit_out_lap BOOLEAN,
        duration_sector_1 DOUBLE, duration_sector_2 DOUBLE, duration_sector_3 DOUBLE,
        i1_speed INT, i2_speed INT, st_speed INT, segments_sector_1 ARRAY<INT>,
        segments_sector_2 ARRAY<INT>, segments_sector_3 ARRAY<INT>, batch_day STRING,
        session_name STRING""",
    "locations": """
        session_key BIGINT, meeting_key BIGINT, driver_number BIGINT, date STRING,
        x INT, y INT, z INT, batch_day STRING, session_name STRING""",
}

# Text times that a typed reader also parses.
TIME_COLUMNS = {
    "sessions": ("date_start", "date_end"),
    "drivers": (),
    "laps": ("date_start",),
    "locations": ("date",),
}


def entity_schema(entity: str) -> StructType:
    """The schema of an entity; an unknown one raises ``KeyError``."""
    if entity not in DDL:
        raise KeyError(f"unknown entity {entity!r}; known: {', '.join(DDL)}")
    return StructType.fromDDL(DDL[entity])
