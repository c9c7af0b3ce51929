"""Checking SQL: every layer as common table expressions over the given tables."""

from __future__ import annotations

import re

from stintlake.functions import fixed_values as fv
from stintlake.sources import adapters


def key(*cols: str) -> str:
    parts = [f"COALESCE(CAST({c} AS VARCHAR), '{fv.KEY_NULL}')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the printed number, as Spark rounds doubles."""
    return (
        f"CAST(ROUND(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 20)), {digits})"
        " AS DOUBLE)"
    )


def mean(x: str, where: str = "") -> str:
    """Mean from a sum of decimals, so that the order of rows does not matter.

    Casts go through text, which keeps every printed digit.
    """
    f = f" FILTER (WHERE {where})" if where else ""
    return (
        f"(CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18))){f} AS VARCHAR) AS DOUBLE)"
        f" / NULLIF(COUNT({x}){f}, 0))"
    )


def label(col: str, rules, default: str) -> str:
    cases = []
    for name, include, exclude in rules:
        test = "(" + " OR ".join(f"contains(lower({col}), '{w}')" for w in include) + ")"
        for w in exclude:
            test += f" AND NOT contains(lower({col}), '{w}')"
        cases.append(f"WHEN {test} THEN '{name}'")
    return f"CASE {' '.join(cases)} ELSE '{default}' END"


def ts(col: str) -> str:
    """All fixture times end in +00:00, so their first 19 characters are UTC."""
    return f"TRY_CAST(SUBSTR({col}, 1, 19) AS TIMESTAMP)"


_SECTORS = "COALESCE(duration_sector_1,0)+COALESCE(duration_sector_2,0)+COALESCE(duration_sector_3,0)"
_SECTOR_COUNT = "+".join(
    f"CAST(duration_sector_{n} IS NOT NULL AS INT)" for n in (1, 2, 3)
)
_DIM_SESSION = "session_name, session_category, location, session_date"

CTES: dict[str, str] = {
    "keyed": adapters.KEYED_LINEITEM.format(lineitem="lineitem"),
    "numbered": f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY session_key, driver_number
        ORDER BY {', '.join(adapters.LAP_ORDER)}) AS lap_number FROM keyed""",
    "bronze_laps": f"""SELECT * EXCLUDE (l_linenumber),
        CAST(l_linenumber AS VARCHAR) || '|2048' AS segments_sector_1,
        CAST(l_linenumber + 2048 AS VARCHAR) || '|2051' AS segments_sector_2,
        CAST('' AS VARCHAR) AS segments_sector_3
        FROM ({adapters.LAPS.format(numbered='numbered')})""",
    "bronze_sessions": adapters.SESSIONS.format(orders="orders", nation="nation"),
    "bronze_drivers": adapters.DRIVERS.format(keyed="keyed", supplier="supplier"),
    "bronze_locations": adapters.LOCATIONS.format(events="events"),
    "event_sessions": adapters.EVENT_SESSIONS.format(events="events"),
    "silver_sessions": f"""
        SELECT session_key, COALESCE(session_name, 'Unknown') AS session_name,
          COALESCE(session_type, session_name) AS session_type, date_start, date_end, gmt_offset,
          meeting_key, COALESCE(location, 'Unknown') AS location, country_key, country_code,
          COALESCE(country_name, 'Unknown') AS country_name, circuit_key, circuit_short_name, year,
          {rnd(f"(epoch({ts('date_end')}) - epoch({ts('date_start')})) / 60e0", 2)}
            AS session_duration_minutes,
          {label('session_name', fv.SESSION_CATEGORIES, fv.OTHER)} AS session_category,
          _ingestion_timestamp
        FROM bronze_sessions WHERE session_key IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (PARTITION BY session_key
          ORDER BY _ingestion_timestamp DESC, bronze_sessions.session_name NULLS FIRST,
            bronze_sessions.session_type NULLS FIRST, date_start NULLS FIRST,
            date_end NULLS FIRST) = 1""",
    "silver_drivers": f"""
        SELECT session_key, meeting_key, driver_number,
          COALESCE(broadcast_name, full_name, first_name || ' ' || last_name) AS broadcast_name,
          COALESCE(full_name, broadcast_name) AS full_name, name_acronym,
          COALESCE(team_name, 'Unknown Team') AS team_name,
          COALESCE(team_colour, '000000') AS team_colour, first_name, last_name, headshot_url,
          country_code, {label('team_name', fv.TEAM_CATEGORIES, fv.OTHER)} AS team_category,
          _ingestion_timestamp
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY session_key, driver_number
                ORDER BY _ingestion_timestamp DESC, team_name NULLS FIRST,
                  team_colour NULLS FIRST, full_name NULLS FIRST, broadcast_name NULLS FIRST) AS pick
              FROM bronze_drivers WHERE session_key IS NOT NULL AND driver_number IS NOT NULL)
        WHERE pick = 1""",
    "silver_laps": f"""
        SELECT session_key, meeting_key, driver_number, lap_number, date_start, lap_duration,
          COALESCE(is_pit_out_lap, FALSE) AS is_pit_out_lap,
          duration_sector_1, duration_sector_2, duration_sector_3,
          i1_speed AS intermediate_1_speed, i2_speed AS intermediate_2_speed,
          st_speed AS speed_trap_speed, segments_sector_1, segments_sector_2, segments_sector_3,
          {_SECTORS} AS calculated_lap_duration,
          lap_duration - ({_SECTORS}) AS sector_duration_delta,
          COALESCE(lap_duration >= 10 AND lap_duration <= 300, FALSE)
            AND COALESCE(is_pit_out_lap, FALSE) = FALSE AS is_valid_lap,
          (['No Sectors', 'Partial', 'Partial', 'Complete'])[{_SECTOR_COUNT} + 1]
            AS sector_completeness,
          list_max([COALESCE(i1_speed, 0), COALESCE(i2_speed, 0), COALESCE(st_speed, 0)])
            AS max_speed,
          batch_day, session_name, _ingestion_timestamp
        FROM bronze_laps b
        WHERE session_key IS NOT NULL AND driver_number IS NOT NULL AND lap_number IS NOT NULL""",
    "silver_locations": """
        SELECT session_key, meeting_key, driver_number, date, x AS position_x, y AS position_y,
          COALESCE(z, 0) AS position_z,
          SQRT(CAST(x AS DOUBLE) * x + CAST(y AS DOUBLE) * y) AS distance_from_origin,
          batch_day, session_name, _ingestion_timestamp
        FROM bronze_locations
        WHERE session_key IS NOT NULL AND driver_number IS NOT NULL AND date IS NOT NULL
          AND x IS NOT NULL AND y IS NOT NULL""",
    "dim_sessions": f"""
        SELECT {key('session_key')} AS session_dim_key, * EXCLUDE (_ingestion_timestamp),
          CAST(CAST({ts('date_start')} AS DATE) AS VARCHAR) AS session_date,
          CAST(YEAR({ts('date_start')}) AS INT) AS session_year,
          CAST(MONTH({ts('date_start')}) AS INT) AS session_month,
          CAST(DAYOFWEEK({ts('date_start')}) + 1 AS INT) AS session_day_of_week,
          CAST(WEEKOFYEAR({ts('date_start')}) AS INT) AS session_week_of_year,
          CAST(QUARTER({ts('date_start')}) AS INT) AS session_quarter,
          session_category = 'Race' AS is_race, session_category = 'Qualifying' AS is_qualifying,
          session_category = 'Practice' AS is_practice, session_category = 'Sprint' AS is_sprint
        FROM silver_sessions""",
    "dim_drivers": f"""
        SELECT {key('driver_number')} AS driver_key, driver_number, full_name, broadcast_name,
          name_acronym, team_name, team_colour, team_category, first_name, last_name,
          headshot_url, country_code, TRUE AS is_current
        FROM silver_drivers
        QUALIFY ROW_NUMBER() OVER (PARTITION BY driver_number
          ORDER BY _ingestion_timestamp DESC, session_key DESC) = 1""",
    "ranked_laps": """
        SELECT *,
          ROW_NUMBER() OVER (PARTITION BY session_key, driver_number
            ORDER BY lap_number, date_start NULLS FIRST) AS driver_lap_rank,
          ROW_NUMBER() OVER (PARTITION BY session_key
            ORDER BY lap_duration NULLS FIRST, driver_number, lap_number, date_start NULLS FIRST)
            AS time_rank,
          MIN(lap_duration) FILTER (WHERE is_valid_lap)
            OVER (PARTITION BY session_key, driver_number) AS driver_best_lap_time
        FROM silver_laps""",
    "fact_laps": f"""
        SELECT {key('session_key', 'driver_number', 'lap_number')} AS lap_key,
          {key('session_key')} AS session_dim_key, {key('driver_number')} AS driver_key,
          * EXCLUDE (time_rank, _ingestion_timestamp),
          CASE WHEN is_valid_lap THEN time_rank END AS session_lap_time_rank,
          CASE WHEN is_valid_lap THEN lap_duration - driver_best_lap_time END
            AS delta_to_personal_best,
          COALESCE(lap_duration = driver_best_lap_time, FALSE) AS is_personal_best_lap
        FROM ranked_laps""",
    "current_drivers": """SELECT driver_number, full_name AS driver_name, team_name, team_category
        FROM dim_drivers""",
    "lap_groups": f"""
        SELECT session_key, driver_number, COUNT(*) AS total_laps,
          COUNT(*) FILTER (WHERE is_valid_lap) AS valid_laps,
          COUNT(*) FILTER (WHERE is_pit_out_lap) AS pit_out_laps,
          MIN(lap_duration) FILTER (WHERE is_valid_lap) AS fastest,
          MAX(lap_duration) FILTER (WHERE is_valid_lap) AS slowest,
          {mean('lap_duration', 'is_valid_lap')} AS average,
          STDDEV_SAMP(lap_duration) FILTER (WHERE is_valid_lap) AS spread,
          {', '.join(f"{mean(f'duration_sector_{n}', 'is_valid_lap')} AS a{n}" for n in (1, 2, 3))},
          {', '.join(f"MIN(duration_sector_{n}) FILTER (WHERE is_valid_lap) AS b{n}" for n in (1, 2, 3))},
          MAX(max_speed) AS top_speed, AVG(max_speed) FILTER (WHERE is_valid_lap) AS speed,
          COUNT(*) FILTER (WHERE sector_completeness = 'Complete') AS complete_sector_laps,
          MIN(lap_number) FILTER (WHERE is_valid_lap) AS first_valid_lap,
          ARG_MIN(lap_number, (lap_duration, lap_number)) FILTER (WHERE is_valid_lap) AS best_lap
        FROM silver_laps GROUP BY session_key, driver_number""",
    "driver_session_summary": f"""
        SELECT {key('session_key', 'driver_number')} AS summary_key,
          {key('session_key')} AS session_dim_key, {key('driver_number')} AS driver_key,
          session_key, driver_number, driver_name, team_name, team_category, {_DIM_SESSION},
          total_laps, valid_laps, pit_out_laps,
          {rnd('valid_laps * 100e0 / total_laps', 2)} AS valid_lap_percentage,
          {rnd('fastest', 3)} AS fastest_lap_time, {rnd('slowest', 3)} AS slowest_lap_time,
          {rnd('average', 3)} AS avg_lap_time, {rnd('spread', 3)} AS lap_time_stddev,
          {rnd('slowest - fastest', 3)} AS lap_time_range,
          {', '.join(f"{rnd(f'a{n}', 3)} AS avg_sector_{n}_time" for n in (1, 2, 3))},
          {', '.join(f"{rnd(f'b{n}', 3)} AS best_sector_{n}_time" for n in (1, 2, 3))},
          {rnd('COALESCE(b1,0)+COALESCE(b2,0)+COALESCE(b3,0)', 3)} AS theoretical_best_lap,
          top_speed, {rnd('speed', 1)} AS avg_speed, complete_sector_laps,
          {rnd('spread / NULLIF(average, 0)', 4)} AS consistency_coefficient
        FROM lap_groups JOIN dim_sessions USING (session_key)
        JOIN current_drivers USING (driver_number)""",
    "placed": f"""
        SELECT g.session_key, g.driver_number, fastest, first_valid_lap, best_lap,
          {_DIM_SESSION}, year, driver_name, team_name, team_category,
          MIN(fastest) OVER (PARTITION BY g.session_key) AS lead_time,
          ROW_NUMBER() OVER (PARTITION BY g.session_key ORDER BY fastest, g.driver_number)
            AS position,
          ROW_NUMBER() OVER (PARTITION BY g.session_key, team_category
            ORDER BY fastest, g.driver_number) AS team_position
        FROM lap_groups g JOIN dim_sessions s ON s.session_key = g.session_key
        JOIN current_drivers d ON d.driver_number = g.driver_number
        WHERE fastest IS NOT NULL""",
    "session_leaderboard": f"""
        SELECT {key('session_key', 'driver_number')} AS leaderboard_key,
          {key('session_key')} AS session_dim_key, {key('driver_number')} AS driver_key,
          session_key, driver_number, driver_name, team_name, team_category, {_DIM_SESSION}, year,
          position, team_position, {rnd('fastest', 3)} AS fastest_lap_time,
          first_valid_lap AS fastest_lap_number, best_lap AS lap_of_fastest,
          {rnd('fastest - lead_time', 3)} AS delta_to_fastest,
          {rnd('(fastest - lead_time) / lead_time * 100', 2)} AS gap_percentage,
          position = 1 AS is_fastest, position <= 3 AS is_top_3, position <= 10 AS is_top_10,
          team_position = 1 AS is_fastest_in_team
        FROM placed""",
    "team_groups": f"""
        SELECT session_key, team_category, {_DIM_SESSION},
          COUNT(DISTINCT driver_number) AS drivers_count,
          CAST(SUM(total_laps) AS BIGINT) AS team_total_laps,
          CAST(SUM(valid_laps) AS BIGINT) AS team_valid_laps,
          MIN(fastest_lap_time) AS best, {mean('fastest_lap_time')} AS avg_best,
          MAX(top_speed) AS top, AVG(top_speed) AS avg_top,
          {mean('consistency_coefficient')} AS cons, {mean('lap_time_stddev')} AS sd
        FROM driver_session_summary GROUP BY ALL""",
    "team_performance": f"""
        SELECT {key('session_key', 'team_category')} AS team_performance_key,
          {key('session_key')} AS session_dim_key, session_key, team_category AS team_name,
          {_DIM_SESSION}, drivers_count, team_total_laps, team_valid_laps,
          {rnd('team_valid_laps * 100e0 / team_total_laps', 2)} AS team_valid_lap_percentage,
          {rnd('best', 3)} AS team_fastest_lap, {rnd('avg_best', 3)} AS team_avg_fastest_lap,
          {rnd('avg_best - best', 3)} AS intra_team_gap, top AS team_top_speed,
          {rnd('avg_top', 1)} AS team_avg_top_speed, {rnd('cons', 4)} AS team_avg_consistency,
          {rnd('sd', 3)} AS team_avg_lap_stddev,
          ROW_NUMBER() OVER (PARTITION BY session_key ORDER BY best NULLS FIRST, team_category)
            AS team_rank
        FROM team_groups""",
    "team_history": """
        SELECT driver_number, team_name, team_colour, team_category, valid_from,
          LEAD(valid_from) OVER (PARTITION BY driver_number ORDER BY valid_from) AS valid_to,
          LEAD(valid_from) OVER (PARTITION BY driver_number ORDER BY valid_from) IS NULL
            AS is_current
        FROM (SELECT *, LAG((team_name, team_colour, team_category)) OVER
                (PARTITION BY driver_number ORDER BY valid_from) AS before
              FROM (SELECT driver_number, team_name, team_colour, team_category,
                      _ingestion_timestamp AS valid_from FROM silver_drivers
                    QUALIFY ROW_NUMBER() OVER (PARTITION BY driver_number, _ingestion_timestamp
                      ORDER BY session_key DESC) = 1))
        WHERE before IS NULL OR before <> (team_name, team_colour, team_category)""",
}


def needed(text: str) -> list[str]:
    """Names of the expressions that a text uses, in the order of their definition."""
    found: set[str] = set()

    def visit(sql: str) -> None:
        for word in set(re.findall(r"[a-z_]+", sql)) & set(CTES) - found:
            found.add(word)
            visit(CTES[word])

    visit(text)
    return [n for n in CTES if n in found]


def over(body: str) -> str:
    """A body over the layer names as one statement."""
    parts = [f"{n} AS ({CTES[n]})" for n in needed(body)]
    return f"WITH {', '.join(parts)} {body}" if parts else body
