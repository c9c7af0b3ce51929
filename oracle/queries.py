"""Checking SQL of the registered queries."""

from __future__ import annotations

from oracle.tables import CTES, mean, over, rnd, ts
from stintlake.functions import fixed_values as fv
from stintlake.plans import checks

MODELS = (
    "silver_sessions", "silver_drivers", "silver_laps", "silver_locations", "dim_sessions",
    "dim_drivers", "fact_laps", "driver_session_summary", "session_leaderboard",
    "team_performance",
)
BODIES: dict[str, str] = {
    n: f"SELECT * {'EXCLUDE (_ingestion_timestamp) ' if n.startswith('silver') else ''}FROM {n}"
    for n in MODELS
}


def _counts(tables, extra="") -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS record_count{extra} FROM {t}" for t in tables
    )


_EXPECTED = fv.EXPECTED_COUNTS
_BRONZE3 = ("bronze_sessions", "bronze_drivers", "bronze_laps")
_SILVER = ("silver_sessions", "silver_drivers", "silver_laps", "silver_locations")
_DAY = "CAST(CAST(_ingestion_timestamp AS DATE) AS VARCHAR)"
_LATEST = "session_key = (SELECT MAX(session_key) FROM bronze_sessions)"

# --- bronze reports -------------------------------------------------------------
BODIES |= {
    "bronze_counts": _counts(_BRONZE3),
    "expected_vs_actual": " UNION ALL ".join(
        f"SELECT 'Expected' AS type, '{t}' AS table_name, CAST({n} AS BIGINT) AS record_count"
        f" UNION ALL SELECT 'Actual', '{t}', COUNT(*) FROM {t}"
        for t, n in _EXPECTED.items()
    ),
    "latest_sessions": f"""
        SELECT session_key, session_name, location, date_start, year, {_DAY} AS ingestion_date
        FROM bronze_sessions ORDER BY date_start DESC NULLS LAST, session_key DESC NULLS LAST,
          session_name NULLS LAST, date_end NULLS LAST, _ingestion_timestamp DESC LIMIT 10""",
    "latest_session_drivers": f"""
        SELECT session_key, driver_number, full_name, name_acronym, team_name,
          {_DAY} AS ingestion_date FROM bronze_drivers WHERE {_LATEST}""",
    "latest_session_laps": f"""
        SELECT session_key, driver_number, lap_number, lap_duration, duration_sector_1,
          duration_sector_2, duration_sector_3 FROM bronze_laps
        WHERE {_LATEST} AND driver_number = 1
        ORDER BY lap_number NULLS LAST, lap_duration NULLS LAST, duration_sector_1 NULLS LAST,
          duration_sector_2 NULLS LAST, duration_sector_3 NULLS LAST LIMIT 10""",
    "duplicate_sessions": """SELECT session_key, COUNT(*) AS duplicate_count
        FROM bronze_sessions GROUP BY 1 HAVING COUNT(*) > 1""",
    "sessions_missing_drivers": """
        SELECT s.session_key, s.session_name, s.location,
          COUNT(DISTINCT d.driver_number) AS driver_count
        FROM bronze_sessions s LEFT JOIN bronze_drivers d ON d.session_key = s.session_key
        GROUP BY 1, 2, 3 HAVING driver_count < 20""",
    "sessions_without_laps": """
        SELECT s.session_key, s.session_name, s.location, COUNT(l.lap_number) AS lap_count
        FROM bronze_sessions s LEFT JOIN bronze_laps l ON l.session_key = s.session_key
        GROUP BY 1, 2, 3 HAVING lap_count = 0""",
    "null_keys": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM {t}"
        for t, c in (("bronze_sessions", "session_key"), ("bronze_drivers", "driver_number"),
                     ("bronze_laps", "lap_number"))
    ),
    "sessions_by_year": """SELECT year, COUNT(*) AS session_count,
        COUNT(DISTINCT location) AS unique_locations FROM bronze_sessions GROUP BY year""",
    "sessions_by_type": """SELECT session_name, COUNT(*) AS session_count
        FROM bronze_sessions GROUP BY session_name""",
    "drivers_by_team": """SELECT team_name, COUNT(DISTINCT driver_number) AS unique_drivers,
        COUNT(*) AS driver_session_records FROM bronze_drivers GROUP BY team_name""",
    "lap_stats_by_type": f"""
        SELECT s.session_name, COUNT(DISTINCT s.session_key) AS session_count,
          COUNT(l.lap_number) AS total_laps,
          {rnd(mean('lap_duration'), 3)} AS avg_lap_duration,
          {rnd('MIN(lap_duration)', 3)} AS min_lap_duration,
          {rnd('MAX(lap_duration)', 3)} AS max_lap_duration
        FROM bronze_sessions s JOIN bronze_laps l ON l.session_key = s.session_key
        GROUP BY s.session_name""",
    "driver_participation": """
        SELECT driver_number, MAX(full_name) AS driver_name, MAX(name_acronym) AS acronym,
          COUNT(DISTINCT session_key) AS sessions_participated
        FROM bronze_drivers GROUP BY 1
        ORDER BY sessions_participated DESC, driver_number NULLS LAST LIMIT 25""",
    "metric_values": """
        SELECT 'Total Sessions' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM bronze_sessions
        UNION ALL SELECT 'Unique Sessions in 2024',
          CAST(COUNT(DISTINCT session_key) FILTER (WHERE year = 2024) AS VARCHAR) FROM bronze_sessions
        UNION ALL SELECT 'Date Range', MIN(date_start) || ' to ' || MAX(date_start) FROM bronze_sessions
        UNION ALL SELECT 'Unique Locations', CAST(COUNT(DISTINCT location) AS VARCHAR) FROM bronze_sessions
        UNION ALL SELECT 'Total Drivers (records)', CAST(COUNT(*) AS VARCHAR) FROM bronze_drivers
        UNION ALL SELECT 'Unique Drivers', CAST(COUNT(DISTINCT driver_number) AS VARCHAR) FROM bronze_drivers
        UNION ALL SELECT 'Unique Teams', CAST(COUNT(DISTINCT team_name) AS VARCHAR) FROM bronze_drivers
        UNION ALL SELECT 'Total Laps', CAST(COUNT(*) AS VARCHAR) FROM bronze_laps""",
    "bronze_freshness": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name,
          CAST(CAST(MAX(_ingestion_timestamp) AS DATE) AS VARCHAR) AS latest_ingestion,
          CAST(CAST(MIN(_ingestion_timestamp) AS DATE) AS VARCHAR) AS earliest_ingestion FROM {t}"""
        for t in _BRONZE3
    ),
    "orphaned_drivers": """
        SELECT session_key, driver_number, full_name, team_name FROM bronze_drivers d
        WHERE NOT EXISTS (SELECT 1 FROM bronze_sessions s WHERE s.session_key = d.session_key)
        ORDER BY session_key, driver_number NULLS LAST, team_name NULLS LAST LIMIT 10""",
    "orphaned_bronze_laps": """
        SELECT session_key, driver_number, lap_number, lap_duration FROM bronze_laps l
        WHERE NOT EXISTS (SELECT 1 FROM bronze_sessions s WHERE s.session_key = l.session_key)
        ORDER BY session_key, driver_number NULLS LAST, lap_number NULLS LAST,
          lap_duration NULLS LAST LIMIT 10""",
    "laps_without_driver": """
        SELECT l.session_key, l.driver_number, COUNT(*) AS lap_count FROM bronze_laps l
        WHERE NOT EXISTS (SELECT 1 FROM bronze_drivers d
          WHERE d.session_key = l.session_key AND d.driver_number = l.driver_number)
        GROUP BY 1, 2 ORDER BY 1, 2 NULLS LAST LIMIT 10""",
    "quick_health": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, COUNT(*) AS actual_count,
          CAST({n} AS BIGINT) AS expected_count,
          CASE WHEN COUNT(*) >= 0.9 * {n} THEN '{fv.COUNT_PASS}' WHEN COUNT(*) = 0
            THEN '{fv.COUNT_EMPTY}' ELSE '{fv.COUNT_LOW}' END AS status FROM {t}"""
        for t, n in _EXPECTED.items()
    ),
}

# --- silver and gold reports ------------------------------------------------------
BODIES |= {
    "silver_counts": _counts(_SILVER),
    "silver_sessions_profile": """
        SELECT COUNT(*) AS total_records, COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(*) FILTER (WHERE session_key IS NULL) AS null_session_keys,
          COUNT(*) FILTER (WHERE session_name IS NULL) AS null_session_names,
          COUNT(*) FILTER (WHERE location IS NULL) AS null_locations,
          MIN(date_start) AS earliest_session, MAX(date_start) AS latest_session
        FROM silver_sessions""",
    "session_categories": """SELECT session_category, COUNT(*) AS session_count,
        COUNT(DISTINCT session_key) AS unique_sessions FROM silver_sessions GROUP BY 1""",
    "silver_drivers_profile": """
        SELECT COUNT(*) AS total_records, COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(DISTINCT driver_number) AS unique_drivers,
          COUNT(DISTINCT full_name) AS unique_driver_names,
          COUNT(DISTINCT team_name) AS unique_teams,
          COUNT(*) FILTER (WHERE driver_number IS NULL) AS null_driver_numbers,
          COUNT(*) FILTER (WHERE full_name IS NULL) AS null_full_names FROM silver_drivers""",
    "top_participants": """
        SELECT full_name, driver_number, team_name,
          COUNT(DISTINCT session_key) AS sessions_participated
        FROM silver_drivers WHERE full_name IS NOT NULL GROUP BY ALL
        ORDER BY sessions_participated DESC, driver_number, team_name LIMIT 10""",
    "silver_laps_profile": f"""
        SELECT COUNT(*) AS total_laps, COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(DISTINCT driver_number) AS unique_drivers,
          COUNT(*) FILTER (WHERE lap_duration IS NULL) AS null_lap_durations,
          COUNT(*) FILTER (WHERE is_pit_out_lap) AS pit_out_laps,
          {rnd(mean('lap_duration'), 2)} AS avg_lap_duration_seconds,
          {rnd('MIN(lap_duration)', 2)} AS fastest_lap_seconds,
          {rnd('MAX(lap_duration)', 2)} AS slowest_lap_seconds
        FROM silver_laps WHERE lap_duration IS NOT NULL""",
    "lap_distribution": """
        SELECT session_key, COUNT(*) AS total_laps, COUNT(DISTINCT driver_number) AS drivers_count,
          COUNT(DISTINCT lap_number) AS max_lap_number FROM silver_laps GROUP BY 1
        ORDER BY total_laps DESC, session_key LIMIT 10""",
    "silver_locations_profile": """
        SELECT COUNT(*) AS total_location_points, COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(DISTINCT driver_number) AS unique_drivers,
          COUNT(*) - COUNT(position_x) AS null_x_coords,
          COUNT(*) - COUNT(position_y) AS null_y_coords,
          COUNT(*) - COUNT(position_z) AS null_z_coords FROM silver_locations""",
    "points_per_session": f"""
        SELECT session_key, COUNT(*) AS location_points,
          COUNT(DISTINCT driver_number) AS drivers_count,
          {rnd('COUNT(*) / COUNT(DISTINCT driver_number)', 0)} AS avg_points_per_driver
        FROM silver_locations GROUP BY 1 ORDER BY location_points DESC, session_key LIMIT 10""",
    "dim_sessions_profile": """
        SELECT COUNT(*) AS total_sessions, COUNT(DISTINCT session_key) AS unique_session_keys,
          COUNT(DISTINCT meeting_key) AS unique_meetings,
          COUNT(DISTINCT circuit_key) AS unique_circuits, COUNT(DISTINCT year) AS unique_years,
          MIN(date_start) AS earliest_session, MAX(date_start) AS latest_session
        FROM dim_sessions""",
    "sessions_per_category": """SELECT session_category, COUNT(*) AS session_count,
        COUNT(DISTINCT circuit_key) AS unique_circuits FROM dim_sessions GROUP BY 1""",
    "sessions_per_year": """SELECT year, COUNT(*) AS session_count,
        COUNT(DISTINCT meeting_key) AS meetings, COUNT(DISTINCT circuit_key) AS circuits
        FROM dim_sessions GROUP BY 1""",
    "dim_drivers_profile": """
        SELECT COUNT(*) AS total_driver_records, COUNT(DISTINCT driver_key) AS unique_drivers,
          COUNT(DISTINCT team_name) AS unique_teams,
          COUNT(*) FILTER (WHERE is_current) AS current_records,
          COUNT(*) FILTER (WHERE NOT is_current) AS historical_records FROM dim_drivers""",
    "current_drivers_by_team": """
        SELECT team_name, COUNT(*) AS driver_count,
          COALESCE(STRING_AGG(DISTINCT full_name, ', ' ORDER BY full_name), '') AS drivers
        FROM dim_drivers GROUP BY 1""",
    "fact_laps_profile": f"""
        SELECT COUNT(*) AS total_laps, COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(DISTINCT driver_key) AS unique_drivers,
          COUNT(*) FILTER (WHERE is_valid_lap) AS valid_laps,
          COUNT(*) FILTER (WHERE NOT is_valid_lap) AS invalid_laps,
          {rnd(mean('lap_duration'), 2)} AS avg_lap_duration,
          {rnd('MIN(lap_duration)', 2)} AS fastest_lap, {rnd('MAX(lap_duration)', 2)} AS slowest_lap
        FROM fact_laps WHERE lap_duration IS NOT NULL""",
    "lap_stats_by_session": f"""
        SELECT f.session_key, d.session_name, d.location, COUNT(*) AS total_laps,
          COUNT(DISTINCT f.driver_key) AS drivers, {rnd(mean('lap_duration'), 2)} AS avg_lap_time,
          {rnd('MIN(lap_duration)', 2)} AS fastest_lap
        FROM fact_laps f JOIN dim_sessions d ON d.session_key = f.session_key
        WHERE is_valid_lap GROUP BY ALL ORDER BY total_laps DESC, f.session_key LIMIT 10""",
    "leaderboard_profile": """
        SELECT COUNT(*) AS total_leaderboard_entries,
          COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(DISTINCT driver_number) AS unique_drivers, MIN(position) AS min_position,
          MAX(position) AS max_position FROM session_leaderboard""",
    "latest_leaderboard": """
        SELECT position, l.driver_number, l.driver_name, l.team_name, total_laps,
          l.fastest_lap_time, avg_lap_time, pit_out_laps
        FROM session_leaderboard l JOIN driver_session_summary d
          ON d.session_key = l.session_key AND d.driver_number = l.driver_number
        WHERE l.session_key = (SELECT session_key FROM dim_sessions
          ORDER BY date_start DESC NULLS LAST, session_key DESC LIMIT 1)
        ORDER BY position LIMIT 20""",
    "summary_profile": f"""
        SELECT COUNT(*) AS total_summaries, COUNT(DISTINCT session_key) AS unique_sessions,
          COUNT(DISTINCT driver_number) AS unique_drivers,
          CAST(SUM(total_laps) AS BIGINT) AS all_laps_combined,
          {rnd(mean('avg_lap_time'), 2)} AS overall_avg_lap_time FROM driver_session_summary""",
    "top_performers": f"""
        SELECT driver_name, COUNT(DISTINCT session_key) AS sessions_participated,
          CAST(SUM(total_laps) AS BIGINT) AS total_laps,
          {rnd('MIN(fastest_lap_time)', 2)} AS personal_best_lap,
          {rnd(mean('avg_lap_time'), 2)} AS career_avg_lap_time,
          CAST(SUM(pit_out_laps) AS BIGINT) AS pit_out_laps
        FROM driver_session_summary GROUP BY 1
        ORDER BY sessions_participated DESC, personal_best_lap NULLS LAST,
          driver_name NULLS LAST LIMIT 10""",
    "team_profile": f"""
        SELECT COUNT(*) AS total_team_session_records,
          COUNT(DISTINCT session_key) AS unique_sessions, COUNT(DISTINCT team_name) AS unique_teams,
          CAST(SUM(team_total_laps) AS BIGINT) AS all_laps_combined,
          {rnd(mean('team_avg_fastest_lap'), 2)} AS overall_avg_fastest_lap FROM team_performance""",
    "team_board": f"""
        SELECT team_name, COUNT(DISTINCT session_key) AS sessions,
          CAST(SUM(drivers_count) AS BIGINT) AS total_driver_entries,
          CAST(SUM(team_total_laps) AS BIGINT) AS total_laps,
          {rnd('MIN(team_fastest_lap)', 2)} AS team_best_lap,
          {rnd(mean('team_avg_fastest_lap'), 2)} AS team_avg_lap_time
        FROM team_performance GROUP BY 1 ORDER BY team_best_lap NULLS LAST, team_name LIMIT 10""",
    "bronze_to_silver": " UNION ALL ".join(
        f"""SELECT '{e}' AS entity, b AS bronze_count, s AS silver_count, s - b AS difference,
          {rnd('CAST(s AS DOUBLE) / b * 100', 2)} AS preservation_pct
        FROM (SELECT COUNT(*) AS b FROM bronze_{e}),
          (SELECT {'COUNT(DISTINCT session_key)' if e == 'sessions' else 'COUNT(*)'} AS s
           FROM silver_{e})"""
        for e in fv.ENTITIES
    ),
    "silver_to_gold": " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, s AS silver_count, g AS gold_count, g - s AS difference
        FROM (SELECT COUNT(DISTINCT {k}) AS s FROM {t}), (SELECT COUNT(DISTINCT {k}) AS g FROM {d})"""
        for d, k, t in (("dim_sessions", "session_key", "silver_sessions"),
                        ("dim_drivers", "driver_number", "silver_drivers"))
    ),
    "session_duration_check": f"""
        SELECT session_key, session_name, location, date_start, date_end,
          session_duration_minutes,
          CASE WHEN {' OR '.join(
              f"(session_category = '{c}' AND session_duration_minutes > {m})"
              for c, m in fv.MIN_SESSION_MINUTES)} THEN 'OK' ELSE 'CHECK' END AS duration_check
        FROM dim_sessions WHERE session_duration_minutes IS NOT NULL
        ORDER BY date_start DESC NULLS LAST, session_key DESC LIMIT 20""",
    "unreasonable_laps": f"""
        SELECT f.session_key, d.session_name, driver_number, lap_number, lap_duration,
          CASE WHEN lap_duration < 60 THEN '{fv.VERY_FAST}' WHEN lap_duration > 300
            THEN '{fv.VERY_SLOW}' ELSE '{fv.NORMAL}' END AS lap_classification
        FROM fact_laps f JOIN dim_sessions d ON d.session_key = f.session_key
        WHERE lap_duration < 60 OR lap_duration > 300
        ORDER BY lap_duration, f.session_key, driver_number, lap_number LIMIT 50""",
    "silver_freshness": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name,
          CAST(CAST(MAX(_ingestion_timestamp) AS DATE) AS VARCHAR) AS latest_ingestion,
          COUNT(*) AS records_count FROM {t}""" for t in _SILVER
    ),
    "silver_duplicates": """
        SELECT 'silver_sessions' AS table_name, session_key, CAST(NULL AS BIGINT) AS driver_number,
          COUNT(*) AS duplicate_count FROM silver_sessions GROUP BY session_key HAVING COUNT(*) > 1
        UNION ALL
        SELECT 'silver_drivers', session_key, driver_number, COUNT(*) FROM silver_drivers
        GROUP BY session_key, driver_number HAVING COUNT(*) > 1""",
    "all_layer_health": " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, COUNT(*) AS record_count FROM {t}"
        for layer, tables in {
            "BRONZE LAYER": (*_BRONZE3, "bronze_locations"),
            "SILVER LAYER": _SILVER,
            "GOLD LAYER - DIMS": ("dim_sessions", "dim_drivers"),
            "GOLD LAYER - FACTS": ("fact_laps",),
            "GOLD LAYER - MARTS":
                ("session_leaderboard", "driver_session_summary", "team_performance"),
        }.items() for t in tables
    ),
    "top_ten_per_session": """
        SELECT session_key, session_name, session_category, location, position, driver_name,
          team_name, fastest_lap_time AS fastest_lap, delta_to_fastest AS delta,
          gap_percentage AS gap_pct, is_top_3, is_fastest_in_team
        FROM session_leaderboard WHERE position <= 10""",
    "driver_performance": """
        SELECT session_key, driver_number, driver_name, team_name, session_name, session_category,
          total_laps, valid_laps, fastest_lap_time AS fastest_lap, avg_lap_time AS avg_lap,
          lap_time_stddev AS lap_stddev, consistency_coefficient AS consistency, top_speed
        FROM driver_session_summary""",
    "race_team_ranking": """
        SELECT session_key, session_name, session_category, team_rank, team_name, drivers_count,
          team_fastest_lap AS team_fastest, team_avg_fastest_lap AS team_avg,
          intra_team_gap AS gap_between_drivers, team_avg_consistency AS avg_consistency,
          team_top_speed FROM team_performance WHERE session_category = 'Race'""",
    "critical_nulls": """
        SELECT 'dim_sessions - NULL session_key' AS check_name, COUNT(*) AS issue_count
        FROM dim_sessions WHERE session_key IS NULL
        UNION ALL SELECT 'fact_laps - NULL lap_duration (valid laps)', COUNT(*)
        FROM fact_laps WHERE lap_duration IS NULL AND is_valid_lap
        UNION ALL SELECT 'session_leaderboard - NULL position', COUNT(*)
        FROM session_leaderboard WHERE position IS NULL
        UNION ALL SELECT 'driver_session_summary - NULL fastest_lap_time', COUNT(*)
        FROM driver_session_summary WHERE fastest_lap_time IS NULL""",
    "silver_gold_lineage": " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, s AS silver_count, g AS gold_count,
          CASE WHEN s = g THEN '{fv.EQUAL_PASS}' ELSE '{fv.EQUAL_FAIL}' END AS status
        FROM (SELECT {c} AS s FROM {a}), (SELECT COUNT(*) AS g FROM {b})"""
        for name, c, a, b in (
            ("Sessions: Silver vs Gold", "COUNT(DISTINCT session_key)", "silver_sessions", "dim_sessions"),
            ("Laps: Silver vs Gold", "COUNT(*)", "silver_laps", "fact_laps"),
        )
    ),
    "first_position_flags": f"""
        SELECT session_name, COUNT(*) AS sessions_validated,
          COUNT(*) FILTER (WHERE is_fastest) AS correct_fastest_flags,
          CASE WHEN COUNT(*) = COUNT(*) FILTER (WHERE is_fastest) THEN '{fv.EQUAL_PASS}'
            ELSE '{fv.EQUAL_FAIL}' END AS validation_status
        FROM session_leaderboard WHERE position = 1 GROUP BY session_name""",
    "team_driver_counts": f"""
        SELECT session_key, session_name, team_name, reported_count, actual_count,
          CASE WHEN reported_count = actual_count THEN '{fv.EQUAL_PASS}' ELSE '{fv.EQUAL_FAIL}' END
            AS validation_status
        FROM (SELECT session_key, session_name, team_name, drivers_count AS reported_count,
          (SELECT COUNT(DISTINCT driver_number) FROM driver_session_summary d
           WHERE d.session_name = t.session_name AND d.team_name = t.team_name) AS actual_count
          FROM team_performance t)""",
    "top_qualifying_laps": """
        SELECT session_key, driver_number, session_name, location, driver_name, team_name,
          fastest_lap_time AS lap_time, position FROM session_leaderboard
        WHERE session_category = 'Qualifying'
        ORDER BY fastest_lap_time, session_key, driver_number LIMIT 5""",
    "consistency_ranking": """
        SELECT session_key, driver_number, driver_name, team_name, session_name,
          consistency_coefficient AS consistency, valid_laps, lap_time_stddev AS stddev
        FROM driver_session_summary WHERE valid_laps >= 10
        ORDER BY consistency_coefficient, session_key, driver_number LIMIT 10""",
    "team_battle": f"""
        SELECT team_name, COUNT(*) AS sessions_participated, AVG(team_rank) AS avg_rank,
          MIN(team_rank) AS best_rank, {mean('team_fastest_lap')} AS avg_fastest_lap,
          {mean('team_avg_consistency')} AS avg_consistency
        FROM team_performance WHERE session_category = 'Race' GROUP BY team_name""",
    "star_join_top_laps": """
        SELECT f.session_key, f.driver_number, s.session_name, s.location, s.session_date,
          d.full_name AS driver_name, d.team_name, lap_number, lap_duration, is_valid_lap, max_speed
        FROM fact_laps f JOIN dim_sessions s ON s.session_dim_key = f.session_dim_key
        JOIN dim_drivers d ON d.driver_key = f.driver_key
        WHERE is_valid_lap AND session_category = 'Qualifying'
        ORDER BY lap_duration, f.session_key, f.driver_number, lap_number LIMIT 10""",
    "leaderboard_of": """
        SELECT session_key, position, driver_name, team_name, fastest_lap_time, delta_to_fastest,
          gap_percentage, is_top_3, is_fastest_in_team
        FROM session_leaderboard WHERE session_category = 'Race'""",
    "drivers_like": """
        SELECT session_key, session_name, session_date, driver_name, team_name, total_laps,
          valid_laps, fastest_lap_time, avg_lap_time, consistency_coefficient, top_speed
        FROM driver_session_summary WHERE driver_name LIKE '%#00000001%'""",
    "team_rankings": """
        SELECT session_key, session_name, session_date, team_rank, team_name, drivers_count,
          team_fastest_lap, intra_team_gap, team_avg_consistency
        FROM team_performance WHERE session_category = 'Race'""",
    "fastest_lap_per_driver": """
        SELECT driver_number, full_name AS driver_name, MIN(lap_duration) AS fastest_lap
        FROM fact_laps JOIN dim_drivers USING (driver_number) WHERE is_valid_lap
        GROUP BY 1, 2 ORDER BY fastest_lap, driver_number LIMIT 10""",
    "session_list": """SELECT session_key, session_name, location, year, session_category, date_start
        FROM dim_sessions""",
    "newest_sessions": """
        SELECT session_key, session_name, session_category, session_date, session_year
        FROM dim_sessions ORDER BY session_date DESC NULLS LAST, session_key DESC LIMIT 5""",
    "fastest_valid_laps": """
        SELECT session_key, driver_number, lap_number, lap_duration, is_valid_lap
        FROM fact_laps WHERE is_valid_lap
        ORDER BY lap_duration, session_key, driver_number, lap_number LIMIT 10""",
    "driver_season_stats": f"""
        SELECT driver_number, driver_name, year, COUNT(DISTINCT session_key) AS sessions,
          {mean('fastest_lap_time')} AS avg_fastest_lap,
          COUNT(*) FILTER (WHERE position <= 3) AS podiums
        FROM session_leaderboard GROUP BY ALL""",
    "sector_distribution": """SELECT sector_completeness, COUNT(*) AS lap_count
        FROM silver_laps GROUP BY 1""",
}


# --- data quality -----------------------------------------------------------------
def _check_sql(table: str, check) -> str:
    if check.kind == "unique":
        n = f"(SELECT COUNT(*) FROM (SELECT {check.expr} AS k FROM {table} GROUP BY 1 HAVING k IS NOT NULL AND COUNT(*) > 1))"
    elif check.kind == "relationship":
        parent, column = check.parent
        n = (f"(SELECT COUNT(*) FROM {table} c WHERE {check.expr} IS NOT NULL AND NOT EXISTS"
             f" (SELECT 1 FROM {parent} p WHERE p.{column} = c.{check.expr}))")
    else:
        where = f" AND ({check.where})" if check.where else ""
        n = f"(SELECT COUNT(*) FROM stamped_{table} WHERE NOT ({check.expr}){where})"
    bad = "warn" if check.severity == "warn" else "fail"
    return (
        f"SELECT '{table}' AS table_name, '{check.name}' AS check_name,"
        f" '{check.severity}' AS severity, n AS violations,"
        f" CASE WHEN n = 0 THEN 'pass' ELSE '{bad}' END AS status FROM (SELECT {n} AS n)"
    )


def _checks(listed) -> str:
    stamped = ", ".join(
        f"stamped_{t} AS (SELECT *, 1 AS updated_at, 1 AS valid_from FROM {t})" for t in listed
    )
    parts = " UNION ALL ".join(_check_sql(t, c) for t, cs in listed.items() for c in cs)
    return f"SELECT * FROM (WITH {stamped} {parts})"


_WITH_GAPS = """(SELECT session_key, position FROM session_leaderboard UNION ALL
    SELECT session_key, CAST(1000 AS BIGINT) FROM session_leaderboard
    WHERE position = 1 AND session_key % 3 = 0)"""

BODIES |= {
    "dq_bronze": _checks(checks.BRONZE_CHECKS),
    "dq_silver": _checks(checks.SILVER_CHECKS),
    "dq_core": _checks(checks.CORE_CHECKS),
    "dq_marts": _checks(checks.MART_CHECKS),
    "orphaned_laps": """
        SELECT DISTINCT l.session_key, l.driver_number, 'Missing driver record' AS issue
        FROM silver_laps l WHERE (l.session_key, l.driver_number) NOT IN
          (SELECT (session_key, driver_number) FROM silver_drivers)
        UNION ALL SELECT DISTINCT l.session_key, l.driver_number, 'Missing session record'
        FROM silver_laps l WHERE l.session_key NOT IN (SELECT session_key FROM silver_sessions)""",
    "summary_mismatches": """
        SELECT session_key, driver_number, total_laps AS summary_total, n AS actual_total_laps,
          valid_laps AS summary_valid, v AS actual_valid_laps
        FROM driver_session_summary JOIN (SELECT session_key, driver_number, COUNT(*) AS n,
            COUNT(*) FILTER (WHERE is_valid_lap) AS v FROM silver_laps GROUP BY 1, 2)
          USING (session_key, driver_number) WHERE total_laps <> n OR valid_laps <> v""",
    "reconcile_bronze": """
        SELECT session_key, driver_number, total_laps, n AS landed_laps
        FROM driver_session_summary JOIN (SELECT session_key, driver_number, COUNT(*) AS n
          FROM bronze_laps GROUP BY 1, 2) USING (session_key, driver_number)
        WHERE total_laps <> n""",
    "fastest_lap_mismatches": """
        SELECT session_key, fastest_lap_time AS leaderboard_fastest, m AS fact_fastest,
          ABS(fastest_lap_time - m) AS difference
        FROM session_leaderboard JOIN (SELECT session_key, MIN(lap_duration) AS m FROM fact_laps
            WHERE is_valid_lap AND session_key IN (SELECT session_key FROM dim_sessions) GROUP BY 1)
          USING (session_key) WHERE position = 1 AND ABS(fastest_lap_time - m) > 0.01""",
    "position_gaps": f"""
        SELECT session_key, position AS actual_position, e AS expected_position,
          'Position gap detected' AS issue
        FROM (SELECT session_key, position,
                ROW_NUMBER() OVER (PARTITION BY session_key ORDER BY position) AS e
              FROM {_WITH_GAPS}) WHERE position <> e""",
    "position_steps": f"""
        SELECT * FROM (SELECT session_key, position,
            LAG(position) OVER (PARTITION BY session_key ORDER BY position) AS prev_position
          FROM {_WITH_GAPS})
        WHERE position <> COALESCE(prev_position + 1, 1)""",
    "team_count_mismatches": """
        SELECT session_key, t.team_name, drivers_count AS reported_count, n AS actual_count,
          drivers_count - n AS difference
        FROM team_performance t JOIN (SELECT session_key, team_category AS team_name,
            COUNT(DISTINCT driver_number) AS n FROM silver_drivers GROUP BY 1, 2)
          USING (session_key, team_name) WHERE drivers_count <> n""",
    "not_one_current": """SELECT driver_number, COUNT(*) FILTER (WHERE is_current) AS current_count
        FROM (SELECT * FROM team_history UNION ALL
          SELECT * FROM team_history WHERE team_category = 'Ferrari')
        GROUP BY 1 HAVING current_count <> 1""",
    "no_future_dates": """
        SELECT CAST(_ingestion_timestamp AS VARCHAR) AS date_value, COUNT(*) AS violation_count
        FROM bronze_drivers WHERE _ingestion_timestamp > TIMESTAMP '2000-01-01' GROUP BY 1""",
    "positive_values": """SELECT duration_sector_3 AS value, COUNT(*) AS violation_count
        FROM bronze_laps WHERE duration_sector_3 <= 0 GROUP BY 1""",
    "reasonable_lap_time": """SELECT lap_duration AS lap_time, COUNT(*) AS violation_count
        FROM bronze_laps WHERE lap_duration < 30 OR lap_duration > 300 GROUP BY 1""",
    "valid_percentage": """SELECT gap_percentage AS percentage_value, COUNT(*) AS violation_count
        FROM session_leaderboard WHERE gap_percentage < 0 OR gap_percentage > 100 GROUP BY 1""",
    "completeness": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS present, COUNT(*) AS total,
          {rnd(f'COUNT({c}) / COUNT(*)', 6)} AS completeness FROM bronze_laps"""
        for c in ("lap_duration", "duration_sector_1", "duration_sector_3", "st_speed")
    ),
    "lap_time_range": """SELECT session_key, driver_number, lap_number, lap_duration
        FROM silver_laps WHERE lap_duration < 50 OR lap_duration > 300""",
    "staleness": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, h AS hours_stale, h > 48 AS is_stale
        FROM (SELECT CAST(FLOOR((epoch(TIMESTAMP '2001-11-05 06:30:00')
          - epoch(MAX(_ingestion_timestamp))) / 3600) AS BIGINT) AS h FROM {t})"""
        for t in _BRONZE3
    ),
    "counts_in_range": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, COUNT(*) AS record_count, {lo} AS min_count,
          {hi} AS max_count, COUNT(*) BETWEEN {lo} AND {hi} AS in_range FROM {t}"""
        for t, (lo, hi) in fv.ROW_RANGES.items()
    ),
}

# --- incremental loads and history ---------------------------------------------------
_LAP = "session_key, driver_number, lap_number, lap_duration"
_NOT_NULL = "session_key IS NOT NULL AND driver_number IS NOT NULL AND lap_number IS NOT NULL"


def _side(name: str, test: str) -> str:
    """The silver rules over one load: the layer text with its source replaced."""
    source = f"(SELECT * FROM bronze_drivers WHERE _ingestion_timestamp {test} TIMESTAMP '1998-06-15')"
    return f"{name} AS ({CTES['silver_drivers'].replace('FROM bronze_drivers', f'FROM {source}')})"


def _merge(update_all: bool) -> str:
    kept = "new_rows" if update_all else "old_rows"
    other = "old_rows" if update_all else "new_rows"
    return f"""SELECT * FROM (
        WITH {_side('old_rows', '<')}, {_side('new_rows', '>=')}
        SELECT COALESCE(o.session_key, n.session_key) AS session_key,
          COALESCE(o.driver_number, n.driver_number) AS driver_number,
          COALESCE(n.team_name, o.team_name) AS team_name,
          COALESCE(n.team_colour, o.team_colour) AS team_colour,
          COALESCE({kept}.team_category, {other}.team_category) AS team_category,
          CAST(CAST(COALESCE({kept}._ingestion_timestamp, {other}._ingestion_timestamp) AS DATE)
            AS VARCHAR) AS ingested,
          CASE WHEN o.session_key IS NULL THEN 'inserted' WHEN n.session_key IS NULL THEN 'kept'
            ELSE 'updated' END AS _merge
        FROM old_rows o FULL JOIN new_rows n
          ON o.session_key = n.session_key AND o.driver_number = n.driver_number)
        """.replace("old_rows.", "o.").replace("new_rows.", "n.")


BODIES |= {
    "merge_touched": f"""SELECT session_key, driver_number, team_name, team_category,
        FALSE AS wrongly_placed FROM (
        WITH {_side('old_rows', '<')}, {_side('new_rows', '>=')}
        SELECT * FROM old_rows WHERE (session_key, driver_number) NOT IN
          (SELECT session_key, driver_number FROM new_rows WHERE session_key = 199901 AND driver_number < 12)
        UNION ALL SELECT * FROM new_rows WHERE session_key = 199901 AND driver_number < 12)""",
    "append_resumed": f"SELECT {_LAP}, batch_day FROM silver_laps",
    "hwm_read": f"""SELECT {_LAP} FROM bronze_laps WHERE _ingestion_timestamp >
        (SELECT MAX(_ingestion_timestamp) FROM bronze_laps
         WHERE _ingestion_timestamp <= TIMESTAMP '1998-01-01')""",
    "merge_partial": _merge(False),
    "merge_all": _merge(True),
    "append_dedupe": f"""
        SELECT {_LAP} FROM bronze_laps b WHERE {_NOT_NULL}
          AND _ingestion_timestamp >= TIMESTAMP '1998-01-01'
          AND NOT EXISTS (SELECT 1 FROM bronze_laps o WHERE o.session_key = b.session_key
            AND o.driver_number = b.driver_number AND o.lap_number = b.lap_number
            AND o._ingestion_timestamp <= TIMESTAMP '1998-01-01')""",
    "snapshot_drivers": """
        SELECT * FROM (
        WITH loads AS (SELECT *, _ingestion_timestamp AS u FROM silver_drivers),
        a AS (SELECT * FROM loads WHERE session_key < 199800 QUALIFY ROW_NUMBER() OVER
          (PARTITION BY driver_number ORDER BY u DESC, team_name, full_name NULLS FIRST) = 1),
        b AS (SELECT * FROM loads WHERE team_category <> 'Ferrari'
          QUALIFY ROW_NUMBER() OVER
          (PARTITION BY driver_number ORDER BY u DESC, team_name, full_name NULLS FIRST) = 1),
        versions AS (
          SELECT a.driver_number, a.team_name, a.team_category, a.u AS f,
            CASE WHEN b.u > a.u THEN b.u
              WHEN b.u IS NULL THEN TIMESTAMP '2002-01-01' END AS t
          FROM a LEFT JOIN b ON b.driver_number = a.driver_number
          UNION ALL
          SELECT b.driver_number, b.team_name, b.team_category, b.u, NULL
          FROM b LEFT JOIN a ON a.driver_number = b.driver_number
          WHERE a.u IS NULL OR b.u > a.u)
        SELECT driver_number, team_name, team_category, CAST(f AS VARCHAR) AS valid_from,
          CAST(t AS VARCHAR) AS valid_to FROM versions)""",
    "snapshot_sessions": """
        SELECT * FROM (
        WITH a AS (SELECT session_key, session_name, _ingestion_timestamp AS u FROM silver_sessions
          WHERE session_key < 200000),
        b AS (SELECT session_key, session_name, CASE WHEN session_category = 'Race'
            THEN TIMESTAMP '2001-09-01' ELSE _ingestion_timestamp END AS u
          FROM silver_sessions WHERE session_key > 199700),
        versions AS (
          SELECT a.session_key, a.session_name, a.u AS f, CASE WHEN b.u > a.u THEN b.u
            WHEN b.u IS NULL THEN TIMESTAMP '2002-01-01' END AS t
          FROM a LEFT JOIN b ON b.session_key = a.session_key
          UNION ALL
          SELECT b.session_key, b.session_name, b.u, NULL
          FROM b LEFT JOIN a ON a.session_key = b.session_key WHERE a.u IS NULL OR b.u > a.u)
        SELECT session_key, session_name, CAST(f AS VARCHAR) AS valid_from,
          CAST(t AS VARCHAR) AS valid_to FROM versions)""",
    "scd2_changes": """SELECT driver_number, team_name, team_colour, team_category,
        CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current
        FROM team_history""",
    "driver_history": """
        SELECT driver_number, team_name, team_colour, team_category,
          CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
          is_current
        FROM team_history WHERE driver_number IN
          (SELECT driver_number FROM team_history GROUP BY 1 HAVING COUNT(*) > 1)
        ORDER BY driver_number, team_history.valid_from LIMIT 50""",
    "asof_team": f"""
        SELECT session_key, l.driver_number, lap_number, team_name,
          CAST(valid_from AS VARCHAR) AS valid_from
        FROM silver_laps l JOIN team_history h ON h.driver_number = l.driver_number
          AND {ts('date_start')} BETWEEN valid_from
            AND COALESCE(valid_to, TIMESTAMP '9999-12-31')""",
    "version_overlaps": f"""
        SELECT * FROM (
        WITH spans AS (SELECT session_key, driver_number, MIN({ts('date_start')}) AS f,
            MAX({ts('date_start')}) + INTERVAL 40 DAY AS t FROM silver_laps GROUP BY 1, 2),
        others AS (SELECT a.driver_number, a.session_key, a.f, a.t, COUNT(*) AS n
          FROM spans a JOIN spans b ON b.driver_number = a.driver_number
            AND b.session_key <> a.session_key AND b.f < a.t AND b.t > a.f GROUP BY ALL)
        SELECT driver_number, CAST(f AS VARCHAR) AS valid_from, CAST(t AS VARCHAR) AS valid_to,
          COUNT(*) AS versions, MAX(n) AS overlaps FROM others GROUP BY 1, 2, 3)""",
    "interval_errors": """
        SELECT driver_number, team_name, CAST(valid_from AS VARCHAR) AS valid_from,
          CAST(valid_to AS VARCHAR) AS valid_to,
          'Current record has non-NULL valid_to' AS issue
        FROM team_history WHERE team_category = 'Ferrari' AND valid_to IS NOT NULL
        UNION ALL
        SELECT driver_number, team_name, CAST(valid_from AS VARCHAR), CAST(valid_to AS VARCHAR),
          'valid_from >= valid_to for historical record'
        FROM team_history WHERE team_category <> 'Ferrari' AND valid_from >= valid_to""",
}

# --- sessions, chunks, ranks, columns --------------------------------------------------
_VIEW = "SELECT session_key, session_name, session_type, date_start, year FROM silver_sessions"
_NEWEST = "ORDER BY COALESCE(date_start, '') DESC, session_key DESC"
_CHUNK0 = f"{ts('date_start')} - INTERVAL 30 MINUTE"
_CLEAN_LOCATION = "REPLACE(REPLACE(s.location, ' ', '_'), '/', '_')"
_STAMP_DAY = "CASE WHEN contains(s.date_start, 'T') THEN string_split(s.date_start, 'T')[1] ELSE 'unknown' END"
_PLAN = f"""(SELECT session_key, CAST(c AS INT) AS chunk,
    {_CHUNK0} + c * INTERVAL 15 MINUTE AS a, {_CHUNK0} + (c + 1) * INTERVAL 15 MINUTE AS b
  FROM event_sessions, (SELECT unnest(range(12)) AS c))"""


def _coverage(by: str) -> str:
    cols = f"session_key{by}"
    series = f"(SELECT DISTINCT {cols} FROM bronze_locations WHERE driver_number IS NOT NULL)"
    on = "l.session_key = p.session_key" + (" AND l.driver_number = p.driver_number" if by else "")
    plan = f"(SELECT * FROM {series} JOIN {_PLAN} USING (session_key))" if by else _PLAN
    return f"""SELECT * FROM (
        WITH counted AS (SELECT {', '.join('p.' + c.strip() for c in cols.split(','))}, p.chunk, p.a, p.b,
            COUNT(l.session_key) AS points
          FROM {plan} p LEFT JOIN bronze_locations l ON {on}
            AND {ts('l.date')} >= p.a AND {ts('l.date')} < p.b GROUP BY ALL),
        runs AS (SELECT *, LIST(points) OVER (PARTITION BY {cols} ORDER BY chunk
          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS last3 FROM counted),
        stops AS (SELECT {cols}, MIN(chunk) AS stop_at FROM runs
          WHERE len(last3) = 3 AND list_max(last3) = 0 GROUP BY ALL)
        SELECT {cols}, chunk, CAST(a AS VARCHAR) AS chunk_start, CAST(b AS VARCHAR) AS chunk_end,
          points, chunk <= COALESCE(stop_at, 99) AS is_read
        FROM counted LEFT JOIN stops USING ({cols}))"""


BODIES |= {
    "select_latest": f"{_VIEW} {_NEWEST} LIMIT 7",
    "select_oldest": f"{_VIEW} ORDER BY COALESCE(date_start, ''), session_key LIMIT 7",
    "select_year": f"{_VIEW} WHERE year = 1998",
    "select_days": f"{_VIEW} WHERE SUBSTR(date_start, 1, 11) IN ('1997-03-01T', '1999-10-01T', '2000-12-01T')",
    "recent_sessions": f"{_VIEW} WHERE year = 1999 {_NEWEST} LIMIT 5",
    "race_sessions": f"{_VIEW} WHERE year = 2000 AND session_type = 'Race' {_NEWEST} LIMIT 10",
    "stamp_children": f"""
        SELECT l.session_key, driver_number, lap_number,
          COALESCE(s.session_name, 'Unknown') AS session_name, {_STAMP_DAY} AS batch_day,
          'laps_' || {_STAMP_DAY} || '_' || COALESCE({_CLEAN_LOCATION}, 'Unknown') || '_'
            || COALESCE(REPLACE(s.session_name, ' ', '_'), 'Unknown') AS file_key
        FROM bronze_laps l LEFT JOIN silver_sessions s ON s.session_key = l.session_key""",
    "chunk_plan": f"""SELECT session_key, chunk, CAST(a AS VARCHAR) AS chunk_start,
        CAST(b AS VARCHAR) AS chunk_end FROM {_PLAN}""",
    "chunk_coverage": _coverage(", driver_number"),
    "session_chunk_coverage": _coverage(""),
    "chunk_points_open": f"""
        SELECT l.session_key, driver_number, date, x, y, chunk FROM bronze_locations l
        JOIN {_PLAN} p ON l.session_key = p.session_key
          AND {ts('l.date')} > p.a AND {ts('l.date')} < p.b""",
    "lap_rank_nulls_last": f"""SELECT {_LAP}, ROW_NUMBER() OVER (PARTITION BY session_key
        ORDER BY lap_duration NULLS LAST, driver_number, lap_number) AS lap_rank FROM silver_laps""",
    "lap_rank_shared": f"""SELECT {_LAP}, RANK() OVER (PARTITION BY session_key
        ORDER BY lap_duration NULLS FIRST) AS lap_rank FROM silver_laps""",
    "lap_rank_dense": f"""SELECT {_LAP}, DENSE_RANK() OVER (PARTITION BY session_key
        ORDER BY lap_duration NULLS LAST) AS lap_rank FROM silver_laps""",
    "team_rank_nulls_last": """SELECT session_key, team_name, team_fastest_lap,
        ROW_NUMBER() OVER (PARTITION BY session_key ORDER BY team_fastest_lap NULLS LAST, team_name)
          AS team_rank FROM team_performance""",
    "personal_best": f"""SELECT {_LAP}, is_valid_lap, MIN(lap_duration) FILTER (WHERE is_valid_lap)
        OVER (PARTITION BY session_key, driver_number) AS best FROM silver_laps""",
    "masked_names": """SELECT session_key, driver_number, LEFT(full_name, 3) || '***@***.com' AS masked,
        md5(CAST(session_key AS VARCHAR) || '-' || CAST(driver_number AS VARCHAR) || '-'
          || COALESCE(full_name, '_dbt_utils_surrogate_key_null_')) AS name_key
        FROM silver_drivers""",
    "mart_filters": """SELECT session_key, driver_number, team_name, position, fastest_lap_time
        FROM session_leaderboard WHERE session_category = 'Race' AND contains(team_name, 'Red Bull')
          AND position <= 20""",
}

# --- sources, sinks, streams -------------------------------------------------------------
_LAP_VIEW = """SELECT session_key, driver_number, lap_number, date_start, lap_duration,
    is_pit_out_lap, i1_speed, segments_sector_1, batch_day FROM bronze_laps"""
BODIES |= {
    "json_reload": _LAP_VIEW,
    "json_inferred": "SELECT session_key, driver_number, full_name, team_name FROM bronze_drivers",
    "csv_reload": _LAP_VIEW.replace(
        "segments_sector_1",
        "'[' || REPLACE(segments_sector_1, '|', ',null,') || ']' AS segments_sector_1",
    ),
    "partition_read": f"SELECT {_LAP}, batch_day FROM silver_laps WHERE batch_day = '1998-05-01'",
    "clustered_read": f"SELECT {_LAP} FROM silver_laps WHERE session_key = 199805",
    "append_new_columns": """
        SELECT session_key, driver_number, team_name,
          CASE WHEN session_key >= 199800 THEN country_code END AS country_code,
          CASE WHEN session_key >= 199800 THEN 'second' ELSE 'first' END AS _ingestion_batch_id
        FROM bronze_drivers""",
    "table_counts": " UNION ALL ".join(
        f"SELECT 'counted_{t}' AS table_name, COUNT(*) AS record_count, 'OK' AS status FROM {t}"
        for t in _BRONZE3
    ) + " UNION ALL SELECT 'counted_bronze_weather', NULL, 'MISSING'",
    "stream_bronze": _LAP_VIEW,
    "stream_quality":
        f"{_LAP_VIEW} WHERE session_key IS NOT NULL AND driver_number IS NOT NULL",
    "stream_evolving": """SELECT session_key, driver_number, date, x, y, z, batch_day
        FROM bronze_locations""",
    "expect_drop": """SELECT session_key, driver_number, date, x, y, z FROM bronze_locations
        WHERE x IS NOT NULL AND y IS NOT NULL""",
    "expectation_counts": " UNION ALL ".join(
        f"""SELECT '{n}' AS expectation, COUNT(*) FILTER (WHERE {p}) AS passed_records,
          COUNT(*) - COUNT(*) FILTER (WHERE {p}) AS failed_records FROM bronze_laps"""
        for n, p in {
            "valid_session_key": "session_key IS NOT NULL",
            "valid_driver_number": "driver_number IS NOT NULL",
            "valid_lap_duration": "lap_duration > 0 OR lap_duration IS NULL",
        }.items()
    ),
}

BODIES |= {
    "snapshot_tables": BODIES["snapshot_drivers"],
    "gold_changed": BODIES["session_leaderboard"],
    "stream_counts": BODIES["expectation_counts"],
    "load_twice": """
        SELECT session_key, session_name, date_start,
          CAST(COALESCE(((session_key % 8) + 8) % 8, 0) AS VARCHAR) AS source_part FROM bronze_sessions""",
    "replace_twice": """
        SELECT session_key, driver_number, team_name FROM silver_drivers
        WHERE session_key % 2 = 0""",
    "json_stamped": "SELECT session_key, driver_number, TRUE AS stamped FROM silver_drivers",
    "merge_new_columns": f"""
        SELECT * FROM (
        WITH {_side('old_rows', '<')}, {_side('new_rows', '>=')}
        SELECT COALESCE(o.session_key, n.session_key) AS session_key,
          COALESCE(o.driver_number, n.driver_number) AS driver_number,
          CASE WHEN n.session_key IS NULL THEN o.team_name ELSE n.team_name END AS team_name,
          o.team_colour, n.country_code,
          CASE WHEN o.session_key IS NULL THEN 'inserted' WHEN n.session_key IS NULL THEN 'kept'
            ELSE 'updated' END AS _merge
        FROM old_rows o FULL JOIN new_rows n
          ON o.session_key = n.session_key AND o.driver_number = n.driver_number)""",
}


BODIES |= {
    "json_mixed": """SELECT session_key, session_name, CASE WHEN session_key % 2 = 1 THEN 'record' END AS shape
        FROM bronze_sessions""",
    "json_unknown_entity": "SELECT session_key, driver_number, name_acronym, team_name FROM bronze_drivers",
    "stream_capped": """SELECT session_key, driver_number, date, x, y, z, TRUE AS capped
        FROM bronze_locations WHERE x IS NOT NULL AND y IS NOT NULL""",
    "stream_interval": _LAP_VIEW,
    "catalog_tables": """
        SELECT * FROM (VALUES ('table', 'bronze_sessions', ''), ('table', 'bronze_drivers', ''),
          ('column', 'driver_number', 'bigint'), ('property', 'quality', 'bronze')) t(kind, name, value)
        UNION ALL SELECT 'rows', 'bronze_sessions', CAST(COUNT(*) AS VARCHAR) FROM bronze_sessions
        UNION ALL SELECT 'rows', 'bronze_drivers', CAST(COUNT(*) AS VARCHAR) FROM bronze_drivers""",
    "hot_mart": " UNION ALL ".join(
        f"SELECT {c} AS name, COUNT(*) AS drivers, MIN(fastest_lap_time) AS fastest FROM session_leaderboard GROUP BY 1"
        for c in ("team_category", "session_category")
    ),
    "summary_mismatches_found": """
        SELECT session_key, driver_number, total_laps AS summary_total, n AS actual_total_laps,
          valid_laps AS summary_valid, v AS actual_valid_laps
        FROM driver_session_summary JOIN (SELECT session_key, driver_number, COUNT(*) AS n,
            COUNT(*) FILTER (WHERE is_valid_lap) AS v
          FROM (SELECT * FROM silver_laps UNION ALL SELECT * FROM silver_laps WHERE driver_number % 10 = 3)
          GROUP BY 1, 2) USING (session_key, driver_number) WHERE total_laps <> n OR valid_laps <> v""",
    "distinct_united": " UNION ALL ".join(
        f"SELECT '{n}' AS measure, COUNT(*) AS exact, TRUE AS within_two_percent"
        f" FROM (SELECT DISTINCT {c} FROM silver_laps) WHERE {c.split(',')[0]} IS NOT NULL"
        for n, c in {"sessions": "session_key", "drivers": "driver_number", "times": "lap_duration",
                     "laps": "session_key, driver_number, lap_number", "speeds": "max_speed"}.items()
    ),
    "silver_duplicates_found": """
        SELECT 'silver_sessions' AS table_name, session_key, CAST(NULL AS BIGINT) AS driver_number,
          CAST(2 AS BIGINT) AS duplicate_count FROM silver_sessions WHERE session_key % 5 = 0
        UNION ALL SELECT 'silver_drivers', session_key, driver_number, 2
        FROM silver_drivers WHERE session_key % 5 = 0""",
}

_LATE = "(driver_number % 7 = 0 AND date < '2024-01-10')"
BODIES |= {
    "checks_merged": BODIES["dq_silver"],
    "history_inserted": BODIES["scd2_changes"],
    "chunk_coverage_stream": "SELECT c.*, COALESCE(late, 0) AS late FROM (" + _coverage(", driver_number").replace(
        "bronze_locations", f"(SELECT * FROM bronze_locations WHERE NOT COALESCE({_LATE}, FALSE))"
    ) + f""") c LEFT JOIN (SELECT session_key, driver_number, COUNT(*) AS late FROM bronze_locations
        WHERE {_LATE} GROUP BY ALL) USING (session_key, driver_number)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: over(body) for name, body in BODIES.items()}
