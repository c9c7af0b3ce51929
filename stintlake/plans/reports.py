"""Reports over the tables of all layers.

Each report takes a :class:`~stintlake.plans.warehouse.Warehouse`. Ranked lists
end their order with a key, so that ties never change which rows are shown.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv
from stintlake.operators.dedupe import duplicate_keys
from stintlake.operators.profile import (
    count_rows,
    freshness,
    preservation,
    profile,
)
from stintlake.plans.checks import duplicates
from stintlake.plans.warehouse import BRONZE, DIMENSIONS, FACTS, MARTS, SILVER, Warehouse


def _top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _desc(col: str) -> Column:
    return F.col(col).desc_nulls_last()


def _asc(col: str) -> Column:
    return F.col(col).asc_nulls_last()


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _distinct(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def _tables(w: Warehouse, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: w.table(n) for n in names}


# --- bronze -------------------------------------------------------------------


def bronze_counts(w: Warehouse) -> DataFrame:
    return count_rows(_tables(w, BRONZE[:3])).orderBy("table_name")


def expected_vs_actual(w: Warehouse) -> DataFrame:
    """Expected rows of a full load beside the rows found."""
    spark = w.bronze_sessions.sparkSession
    expected = spark.createDataFrame(
        [("Expected", t, n) for t, n in fv.EXPECTED_COUNTS.items()],
        "type string, table_name string, record_count long",
    )
    actual = count_rows(
        _tables(w, list(fv.EXPECTED_COUNTS)), {t: {"type": "Actual"} for t in fv.EXPECTED_COUNTS}
    )
    return expected.unionByName(actual).orderBy("table_name", "type")


def latest_sessions(w: Warehouse) -> DataFrame:
    cols = ["session_key", "session_name", "location", "date_start", "year"]
    # One session lands several times, so the load time alone leaves ties.
    order = [_desc("date_start"), _desc("session_key"), _asc("session_name"), _asc("date_end"),
             _desc("_ingestion_timestamp")]
    return _top(w.bronze_sessions, 10, *order).select(
        *cols, F.to_date("_ingestion_timestamp").alias("ingestion_date")
    )


def _of_latest_session(w: Warehouse, rows: DataFrame) -> DataFrame:
    latest = w.bronze_sessions.agg(F.max("session_key").alias("session_key"))
    return rows.join(F.broadcast(latest), "session_key")  # one row


def latest_session_drivers(w: Warehouse) -> DataFrame:
    return _of_latest_session(w, w.bronze_drivers).select(
        "session_key", "driver_number", "full_name", "name_acronym", "team_name",
        F.to_date("_ingestion_timestamp").alias("ingestion_date"),
    ).orderBy("driver_number", "team_name")


def latest_session_laps(w: Warehouse, driver_number: int = 1) -> DataFrame:
    laps = w.bronze_laps.filter(F.col("driver_number") == driver_number)
    cols = ["session_key", "driver_number", "lap_number", "lap_duration", "duration_sector_1",
            "duration_sector_2", "duration_sector_3"]
    rows = _of_latest_session(w, laps).select(*cols)
    return _top(rows, 10, _asc("lap_number"), *[_asc(c) for c in cols[3:]])


def duplicate_sessions(w: Warehouse) -> DataFrame:
    return duplicate_keys(w.bronze_sessions, ["session_key"]).orderBy(
        _desc("duplicate_count"), _asc("session_key")
    )


def sessions_missing_drivers(w: Warehouse, at_least: int = 20) -> DataFrame:
    """Sessions with fewer drivers than expected, none included.

    Drivers are counted per session first, so the join keeps one row per session.
    """
    drivers = w.bronze_drivers.groupBy("session_key").agg(
        F.count_distinct("driver_number").alias("driver_count")
    )
    sessions = w.bronze_sessions.select("session_key", "session_name", "location").distinct()
    return (
        sessions.join(drivers, "session_key", "left")
        .withColumn("driver_count", C.zero_if_null("driver_count"))
        .filter(F.col("driver_count") < at_least)
        .orderBy("driver_count", "session_key", "session_name")
    )


def sessions_without_laps(w: Warehouse) -> DataFrame:
    """Sessions for which no numbered lap was landed."""
    laps = w.bronze_laps.filter("lap_number IS NOT NULL").select("session_key").distinct()
    sessions = w.bronze_sessions.select("session_key", "session_name", "location").distinct()
    return sessions.join(laps, "session_key", "left_anti").select(
        "*", F.lit(0).cast("long").alias("lap_count")
    ).orderBy(_desc("session_key"), _asc("session_name"))


def null_keys(w: Warehouse) -> DataFrame:
    keys = {"bronze_sessions": "session_key", "bronze_drivers": "driver_number",
            "bronze_laps": "lap_number"}
    return _union([
        w.table(t).agg(F.count_if(F.col(c).isNull()).alias("null_count")).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "null_count"
        )
        for t, c in keys.items()
    ])


def sessions_by_year(w: Warehouse) -> DataFrame:
    return profile(
        w.bronze_sessions, by=["year"], total="session_count",
        distinct={"unique_locations": "location"},
    ).orderBy(_desc("year"))


def sessions_by_type(w: Warehouse) -> DataFrame:
    return w.bronze_sessions.groupBy("session_name").agg(
        F.count("*").alias("session_count")
    ).orderBy(_desc("session_count"), "session_name")


def drivers_by_team(w: Warehouse) -> DataFrame:
    return profile(
        w.bronze_drivers, by=["team_name"], total="driver_session_records",
        distinct={"unique_drivers": "driver_number"},
    ).orderBy(_desc("unique_drivers"), "team_name")


def lap_stats_by_type(w: Warehouse) -> DataFrame:
    """Lap statistics per session name over the landed rows.

    A session landed several times counts its laps once per row, as a plain join
    would. Laps are reduced to one row per session before the join, so neither a
    long session nor repeated session rows multiply what is shuffled.
    """
    laps = w.bronze_laps.groupBy("session_key").agg(
        F.count("lap_number").alias("laps"),
        F.sum(C.exact("lap_duration")).alias("units"),
        F.count("lap_duration").alias("timed"),
        F.min("lap_duration").alias("low"),
        F.max("lap_duration").alias("high"),
    )
    rows = w.bronze_sessions.select("session_key", "session_name").join(laps, "session_key")
    return rows.groupBy("session_name").agg(
        F.count_distinct("session_key").alias("session_count"),
        F.sum("laps").alias("total_laps"),
        F.round(C.mean_of(F.sum("units"), F.sum("timed")), 3).alias("avg_lap_duration"),
        F.round(F.min("low"), 3).alias("min_lap_duration"),
        F.round(F.max("high"), 3).alias("max_lap_duration"),
    ).orderBy(_desc("session_count"), "session_name")


def driver_participation(w: Warehouse) -> DataFrame:
    out = w.bronze_drivers.groupBy("driver_number").agg(
        F.max("full_name").alias("driver_name"),
        F.max("name_acronym").alias("acronym"),
        F.count_distinct("session_key").alias("sessions_participated"),
    )
    return _top(out, 25, _desc("sessions_participated"), _asc("driver_number"))


def metric_values(w: Warehouse, year: int = 2024) -> DataFrame:
    """Key figures of the bronze layer as text, from one pass per table."""
    s = profile(
        w.bronze_sessions.withColumn("_y", F.when(F.col("year") == year, F.col("session_key"))),
        distinct={"in_year": "_y", "places": "location"},
        lows={"first": "date_start"}, highs={"last": "date_start"}, total="n",
    )
    d = profile(
        w.bronze_drivers, distinct={"drivers": "driver_number", "teams": "team_name"}, total="n"
    )
    laps = w.bronze_laps.agg(F.count("*").alias("n"))

    def rows(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        pairs = [
            F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value"))
            for m, v in metrics.items()
        ]
        return df.select(F.inline(F.array(*pairs)))

    span = F.concat("first", F.lit(" to "), "last")
    return _union([
        rows(s, {
            "Total Sessions": F.col("n"),
            f"Unique Sessions in {year}": F.col("in_year"),
            "Date Range": span,
            "Unique Locations": F.col("places"),
        }),
        rows(d, {
            "Total Drivers (records)": F.col("n"),
            "Unique Drivers": F.col("drivers"),
            "Unique Teams": F.col("teams"),
        }),
        rows(laps, {"Total Laps": F.col("n")}),
    ])


def bronze_freshness(w: Warehouse) -> DataFrame:
    return freshness(_tables(w, BRONZE[:3])).select(
        "table_name",
        F.to_date("latest_ingestion").alias("latest_ingestion"),
        F.to_date("earliest_ingestion").alias("earliest_ingestion"),
    ).orderBy("table_name")


def orphaned_drivers(w: Warehouse) -> DataFrame:
    """Driver rows of sessions that were not landed (the first ten, by key)."""
    out = w.bronze_drivers.join(
        w.bronze_sessions.select("session_key"), "session_key", "left_anti"
    ).select("session_key", "driver_number", "full_name", "team_name")
    return _top(out, 10, _asc("session_key"), _asc("driver_number"), _asc("team_name"))


def orphaned_bronze_laps(w: Warehouse) -> DataFrame:
    out = w.bronze_laps.join(
        w.bronze_sessions.select("session_key"), "session_key", "left_anti"
    ).select("session_key", "driver_number", "lap_number", "lap_duration")
    return _top(out, 10, _asc("session_key"), _asc("driver_number"), _asc("lap_number"),
                _asc("lap_duration"))


def laps_without_driver(w: Warehouse) -> DataFrame:
    """Sessions and drivers that have laps but no driver row; keyless laps count too."""
    counts = w.bronze_laps.groupBy("session_key", "driver_number").agg(
        F.count("*").alias("lap_count")
    )
    keys = ["session_key", "driver_number"]
    return _top(
        counts.join(w.bronze_drivers.select(*keys), keys, "left_anti"), 10,
        _asc("session_key"), _asc("driver_number"),
    )


def quick_health(w: Warehouse) -> DataFrame:
    counts = count_rows(
        _tables(w, list(fv.EXPECTED_COUNTS)),
        {t: {"expected_count": n} for t, n in fv.EXPECTED_COUNTS.items()},
    )
    return counts.select(
        "table_name",
        F.col("record_count").alias("actual_count"),
        F.col("expected_count").cast("long").alias("expected_count"),
        C.count_status("record_count", "expected_count").alias("status"),
    ).orderBy("table_name")


# --- silver -------------------------------------------------------------------


def silver_counts(w: Warehouse) -> DataFrame:
    return count_rows(_tables(w, SILVER)).orderBy("table_name")


def silver_sessions_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.silver_sessions,
        distinct={"unique_sessions": "session_key"},
        nulls={"null_session_keys": "session_key", "null_session_names": "session_name",
               "null_locations": "location"},
        lows={"earliest_session": "date_start"},
        highs={"latest_session": "date_start"},
    )


def session_categories(w: Warehouse) -> DataFrame:
    return profile(
        w.silver_sessions, by=["session_category"], total="session_count",
        distinct={"unique_sessions": "session_key"},
    ).orderBy(_desc("session_count"), "session_category")


def silver_drivers_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.silver_drivers,
        distinct={"unique_sessions": "session_key", "unique_drivers": "driver_number",
                  "unique_driver_names": "full_name", "unique_teams": "team_name"},
        nulls={"null_driver_numbers": "driver_number", "null_full_names": "full_name"},
    )


def top_participants(w: Warehouse) -> DataFrame:
    out = w.silver_drivers.filter("full_name IS NOT NULL").groupBy(
        "full_name", "driver_number", "team_name"
    ).agg(F.count_distinct("session_key").alias("sessions_participated"))
    return _top(out, 10, _desc("sessions_participated"), "driver_number", "team_name")


def silver_laps_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.silver_laps.filter("lap_duration IS NOT NULL"),
        distinct={"unique_sessions": "session_key", "unique_drivers": "driver_number"},
        nulls={"null_lap_durations": "lap_duration"},
        sums={"pit_out_laps": F.col("is_pit_out_lap").cast("long"),
              "_units": C.exact("lap_duration")},
        lows={"fastest": "lap_duration"},
        highs={"slowest": "lap_duration"},
        total="total_laps",
        reduce_first=True,
    ).select(
        "total_laps", "unique_sessions", "unique_drivers", "null_lap_durations", "pit_out_laps",
        F.round(C.mean_of("_units", "total_laps"), 2).alias("avg_lap_duration_seconds"),
        F.round("fastest", 2).alias("fastest_lap_seconds"),
        F.round("slowest", 2).alias("slowest_lap_seconds"),
    )


def lap_distribution(w: Warehouse) -> DataFrame:
    """Laps, drivers and distinct lap numbers of the ten largest sessions."""
    out = profile(
        w.silver_laps, by=["session_key"], total="total_laps",
        distinct={"drivers_count": "driver_number", "max_lap_number": "lap_number"},
    )
    return _top(out, 10, _desc("total_laps"), "session_key")


def silver_locations_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.silver_locations,
        distinct={"unique_sessions": "session_key", "unique_drivers": "driver_number"},
        nulls={"null_x_coords": "position_x", "null_y_coords": "position_y",
               "null_z_coords": "position_z"},
        total="total_location_points",
        reduce_first=True,
    )


def points_per_session(w: Warehouse) -> DataFrame:
    out = profile(
        w.silver_locations, by=["session_key"], total="location_points",
        distinct={"drivers_count": "driver_number"},
        reduce_first=True,
    ).withColumn(
        "avg_points_per_driver",
        F.round(F.col("location_points") / F.nullif(F.col("drivers_count"), F.lit(0)), 0),
    )
    return _top(out, 10, _desc("location_points"), "session_key")


# --- gold ---------------------------------------------------------------------


def dim_sessions_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.dim_sessions,
        distinct={"unique_session_keys": "session_key", "unique_meetings": "meeting_key",
                  "unique_circuits": "circuit_key", "unique_years": "year"},
        lows={"earliest_session": "date_start"}, highs={"latest_session": "date_start"},
        total="total_sessions",
    )


def sessions_per_category(w: Warehouse) -> DataFrame:
    return profile(
        w.dim_sessions, by=["session_category"], total="session_count",
        distinct={"unique_circuits": "circuit_key"},
    ).orderBy(_desc("session_count"), "session_category")


def sessions_per_year(w: Warehouse) -> DataFrame:
    return profile(
        w.dim_sessions, by=["year"], total="session_count",
        distinct={"meetings": "meeting_key", "circuits": "circuit_key"},
    ).orderBy(_desc("year"))


def dim_drivers_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.dim_drivers,
        distinct={"unique_drivers": "driver_key", "unique_teams": "team_name"},
        sums={"current_records": F.col("is_current").cast("long"),
              "historical_records": (~F.col("is_current")).cast("long")},
        total="total_driver_records",
    )


def current_drivers_by_team(w: Warehouse) -> DataFrame:
    """Current drivers per team with the set of their names, sorted.

    The list is the result; the dimension has one row per driver, and names are
    made distinct before the shuffle.
    """
    return w.dim_drivers.filter("is_current").groupBy("team_name").agg(
        F.count("*").alias("driver_count"),
        F.array_join(F.array_sort(F.collect_set("full_name")), ", ").alias("drivers"),
    ).orderBy(_desc("driver_count"), "team_name")


def driver_history(history: DataFrame) -> DataFrame:
    """Versions of drivers that have more than one, by driver and time (the first 50)."""
    repeated = history.groupBy("driver_number").agg(F.count("*").alias("n")).filter("n > 1")
    rows = history.join(repeated, "driver_number", "left_semi")
    return _top(rows, 50, "driver_number", "valid_from")


def fact_laps_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.fact_laps.filter("lap_duration IS NOT NULL"),
        distinct={"unique_sessions": "session_key", "unique_drivers": "driver_key"},
        sums={"valid_laps": F.col("is_valid_lap").cast("long"),
              "invalid_laps": (~F.col("is_valid_lap")).cast("long"),
              "_units": C.exact("lap_duration")},
        lows={"fastest": "lap_duration"}, highs={"slowest": "lap_duration"},
        total="total_laps",
        reduce_first=True,
    ).select(
        "total_laps", "unique_sessions", "unique_drivers", "valid_laps", "invalid_laps",
        F.round(C.mean_of("_units", "total_laps"), 2).alias("avg_lap_duration"),
        F.round("fastest", 2).alias("fastest_lap"),
        F.round("slowest", 2).alias("slowest_lap"),
    )


def lap_stats_by_session(w: Warehouse) -> DataFrame:
    """Valid-lap statistics of the ten largest sessions; laps are reduced before the join."""
    stats = profile(
        w.fact_laps.filter("is_valid_lap"), by=["session_key"], total="total_laps",
        distinct={"drivers": "driver_key"}, sums={"_units": C.exact("lap_duration")},
        lows={"fastest": "lap_duration"},
        reduce_first=True,
    )
    rows = stats.join(
        w.dim_sessions.select("session_key", "session_name", "location"), "session_key"
    ).select(
        "session_key", "session_name", "location", "total_laps", "drivers",
        F.round(C.mean_of("_units", "total_laps"), 2).alias("avg_lap_time"),
        F.round("fastest", 2).alias("fastest_lap"),
    )
    return _top(rows, 10, _desc("total_laps"), "session_key")


# --- marts --------------------------------------------------------------------


def leaderboard_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.session_leaderboard,
        distinct={"unique_sessions": "session_key", "unique_drivers": "driver_number"},
        lows={"min_position": "position"}, highs={"max_position": "position"},
        total="total_leaderboard_entries",
    )


def latest_leaderboard(w: Warehouse) -> DataFrame:
    """The leaderboard of the session that started last, with lap statistics."""
    # One value, as a literal: the filter then reaches the scan of every table.
    last = _top(w.dim_sessions, 1, _desc("date_start"), _desc("session_key")).first()
    in_latest = F.col("session_key") == F.lit(last.session_key if last else None)
    stats = w.driver_session_summary.filter(in_latest).select(
        "session_key", "driver_number", "total_laps", "avg_lap_time", "pit_out_laps"
    )
    rows = (
        w.session_leaderboard.filter(in_latest)
        .join(stats, ["session_key", "driver_number"])
        .select("position", "driver_number", "driver_name", "team_name", "total_laps",
                "fastest_lap_time", "avg_lap_time", "pit_out_laps")
    )
    return _top(rows, 20, "position")


def summary_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.driver_session_summary,
        distinct={"unique_sessions": "session_key", "unique_drivers": "driver_number"},
        sums={"all_laps_combined": F.col("total_laps"),
              "_units": C.exact("avg_lap_time"),
              "_timed": F.col("avg_lap_time").isNotNull().cast("long")},
        total="total_summaries",
    ).select(
        "total_summaries", "unique_sessions", "unique_drivers", "all_laps_combined",
        F.round(C.mean_of("_units", "_timed"), 2).alias("overall_avg_lap_time"),
    )


def top_performers(w: Warehouse) -> DataFrame:
    out = w.driver_session_summary.groupBy("driver_name").agg(
        F.count_distinct("session_key").alias("sessions_participated"),
        F.sum("total_laps").alias("total_laps"),
        F.round(F.min("fastest_lap_time"), 2).alias("personal_best_lap"),
        F.round(C.mean("avg_lap_time"), 2).alias("career_avg_lap_time"),
        F.sum("pit_out_laps").alias("pit_out_laps"),
    )
    return _top(
        out, 10, _desc("sessions_participated"), _asc("personal_best_lap"), _asc("driver_name")
    )


def team_profile(w: Warehouse) -> DataFrame:
    return profile(
        w.team_performance,
        distinct={"unique_sessions": "session_key", "unique_teams": "team_name"},
        sums={"all_laps_combined": F.col("team_total_laps"),
              "_units": C.exact("team_avg_fastest_lap"),
              "_timed": F.col("team_avg_fastest_lap").isNotNull().cast("long")},
        total="total_team_session_records",
    ).select(
        "total_team_session_records", "unique_sessions", "unique_teams", "all_laps_combined",
        F.round(C.mean_of("_units", "_timed"), 2).alias("overall_avg_fastest_lap"),
    )


def team_board(w: Warehouse) -> DataFrame:
    out = w.team_performance.groupBy("team_name").agg(
        F.count_distinct("session_key").alias("sessions"),
        F.sum("drivers_count").alias("total_driver_entries"),
        F.sum("team_total_laps").alias("total_laps"),
        F.round(F.min("team_fastest_lap"), 2).alias("team_best_lap"),
        F.round(C.mean("team_avg_fastest_lap"), 2).alias("team_avg_lap_time"),
    )
    return _top(out, 10, _asc("team_best_lap"), "team_name")


# --- across layers --------------------------------------------------------------


def bronze_to_silver(w: Warehouse) -> DataFrame:
    """Rows kept from bronze to silver; sessions compare with their distinct keys."""
    names = ("bronze_count", "silver_count")
    parts = []
    for entity in fv.ENTITIES:
        kept = w.table(f"silver_{entity}")
        right = (
            _distinct(kept, "session_key", names[1]) if entity == "sessions"
            else _count(kept, names[1])
        )
        left = _count(w.table(f"bronze_{entity}"), names[0])
        parts.append(preservation("entity", entity, left, right, names))
    return _union(parts)


def silver_to_gold(w: Warehouse) -> DataFrame:
    names = ("silver_count", "gold_count")
    current = w.dim_drivers.filter("is_current")
    pairs = [
        ("dim_sessions", "session_key", w.silver_sessions, w.dim_sessions),
        ("dim_drivers", "driver_number", w.silver_drivers, current),
    ]
    return _union([
        preservation(
            "dimension", label, _distinct(s, key, names[0]), _distinct(g, key, names[1]), names,
            percent=False,
        )
        for label, key, s, g in pairs
    ])


def session_duration_check(w: Warehouse) -> DataFrame:
    rows = w.dim_sessions.filter("session_duration_minutes IS NOT NULL").select(
        "session_key", "session_name", "location", "date_start", "date_end",
        "session_duration_minutes",
        C.duration_check("session_category", "session_duration_minutes").alias("duration_check"),
    )
    return _top(rows, 20, _desc("date_start"), _desc("session_key"))


def unreasonable_laps(w: Warehouse, fast: float = 60, slow: float = 300) -> DataFrame:
    """Timed laps outside the range, fastest first (the first 50)."""
    laps = w.fact_laps.filter(~F.col("lap_duration").between(fast, slow))
    rows = laps.join(
        w.dim_sessions.select("session_key", F.col("session_name").alias("session_title")),
        "session_key",
    ).select(
        "session_key", F.col("session_title").alias("session_name"), "driver_number",
        "lap_number", "lap_duration",
        C.lap_speed_class("lap_duration", fast, slow).alias("lap_classification"),
    )
    return _top(rows, 50, "lap_duration", "session_key", "driver_number", "lap_number")


def silver_freshness(w: Warehouse) -> DataFrame:
    return freshness(_tables(w, SILVER)).select(
        "table_name", F.to_date("latest_ingestion").alias("latest_ingestion"), "records_count"
    ).orderBy("table_name")


def silver_duplicates(w: Warehouse) -> DataFrame:
    """Repeated keys of silver sessions and drivers (none, if the merge holds)."""
    sessions = duplicates(w.silver_sessions, ["session_key"]).select(
        F.lit("silver_sessions").alias("table_name"), "session_key",
        F.lit(None).cast("long").alias("driver_number"), "duplicate_count",
    )
    drivers = duplicates(w.silver_drivers, ["session_key", "driver_number"]).select(
        F.lit("silver_drivers").alias("table_name"), "session_key", "driver_number",
        "duplicate_count",
    )
    return sessions.unionByName(drivers)


LAYERS = {
    "BRONZE LAYER": BRONZE,
    "SILVER LAYER": SILVER,
    "GOLD LAYER - DIMS": DIMENSIONS,
    "GOLD LAYER - FACTS": FACTS,
    "GOLD LAYER - MARTS": MARTS,
}


def all_layer_health(w: Warehouse) -> DataFrame:
    names = {t: layer for layer, tables in LAYERS.items() for t in tables}
    tables = _tables(w, list(names))
    tables["dim_drivers"] = tables["dim_drivers"].filter("is_current")
    return count_rows(tables, {t: {"layer": layer} for t, layer in names.items()}).orderBy(
        "layer", "table_name"
    )


def top_ten_per_session(w: Warehouse) -> DataFrame:
    return w.session_leaderboard.filter("position <= 10").select(
        "session_key", "session_name", "session_category", "location", "position", "driver_name",
        "team_name", F.col("fastest_lap_time").alias("fastest_lap"),
        F.col("delta_to_fastest").alias("delta"), F.col("gap_percentage").alias("gap_pct"),
        "is_top_3", "is_fastest_in_team",
    ).orderBy("session_name", "session_key", "position")


def driver_performance(w: Warehouse) -> DataFrame:
    return w.driver_session_summary.select(
        "session_key", "driver_number", "driver_name", "team_name", "session_name",
        "session_category", "total_laps", "valid_laps",
        F.col("fastest_lap_time").alias("fastest_lap"), F.col("avg_lap_time").alias("avg_lap"),
        F.col("lap_time_stddev").alias("lap_stddev"),
        F.col("consistency_coefficient").alias("consistency"), "top_speed",
    ).orderBy("session_name", "fastest_lap", "session_key", "driver_number")


def race_team_ranking(w: Warehouse) -> DataFrame:
    return w.team_performance.filter("session_category = 'Race'").select(
        "session_key", "session_name", "session_category", "team_rank", "team_name",
        "drivers_count", F.col("team_fastest_lap").alias("team_fastest"),
        F.col("team_avg_fastest_lap").alias("team_avg"),
        F.col("intra_team_gap").alias("gap_between_drivers"),
        F.col("team_avg_consistency").alias("avg_consistency"), "team_top_speed",
    ).orderBy("session_name", "session_key", "team_rank")


def critical_nulls(w: Warehouse) -> DataFrame:
    tests = {
        "dim_sessions - NULL session_key": (w.dim_sessions, "session_key IS NULL"),
        "fact_laps - NULL lap_duration (valid laps)":
            (w.fact_laps, "lap_duration IS NULL AND is_valid_lap = TRUE"),
        "session_leaderboard - NULL position": (w.session_leaderboard, "position IS NULL"),
        "driver_session_summary - NULL fastest_lap_time":
            (w.driver_session_summary, "fastest_lap_time IS NULL"),
    }
    return _union([
        df.agg(F.count_if(F.expr(bad)).alias("issue_count")).select(
            F.lit(name).alias("check_name"), "issue_count"
        )
        for name, (df, bad) in tests.items()
    ])


def silver_gold_lineage(w: Warehouse) -> DataFrame:
    pairs = {
        "Sessions: Silver vs Gold": (
            _distinct(w.silver_sessions, "session_key", "silver_count"),
            _count(w.dim_sessions, "gold_count"),
        ),
        "Laps: Silver vs Gold": (
            _count(w.silver_laps, "silver_count"), _count(w.fact_laps, "gold_count"),
        ),
    }
    return _union([
        s.crossJoin(g).select(  # one row each
            F.lit(name).alias("check_name"), "silver_count", "gold_count",
            C.equal_status("silver_count", "gold_count").alias("status"),
        )
        for name, (s, g) in pairs.items()
    ])


def first_position_flags(w: Warehouse) -> DataFrame:
    counted = w.session_leaderboard.filter("position = 1").groupBy("session_name").agg(
        F.count("*").alias("sessions_validated"),
        F.count_if("is_fastest").alias("correct_fastest_flags"),
    )
    return counted.withColumn(
        "validation_status", C.equal_status("sessions_validated", "correct_fastest_flags")
    )


def team_driver_counts(w: Warehouse) -> DataFrame:
    """Reported and recounted drivers per session name and team name.

    As in the query it follows, the recount matches the mart's category with raw
    team names, so categories that are no team name count zero drivers.
    """
    actual = w.driver_session_summary.groupBy("session_name", "team_name").agg(
        F.count_distinct("driver_number").alias("n")
    )
    teams = w.team_performance.select("session_key", "session_name", "team_name", "drivers_count")
    return (
        teams.join(actual, ["session_name", "team_name"], "left")
        .select(
            "session_key", "session_name", "team_name",
            F.col("drivers_count").alias("reported_count"),
            C.zero_if_null("n").alias("actual_count"),
        )
        .withColumn("validation_status", C.equal_status("reported_count", "actual_count"))
        .orderBy("session_name", "team_name", "session_key")
    )


def top_qualifying_laps(w: Warehouse) -> DataFrame:
    rows = w.session_leaderboard.filter("session_category = 'Qualifying'").select(
        "session_key", "driver_number", "session_name", "location", "driver_name", "team_name",
        F.col("fastest_lap_time").alias("lap_time"), "position",
    )
    return _top(rows, 5, "lap_time", "session_key", "driver_number")


def consistency_ranking(w: Warehouse, least_laps: int = 10) -> DataFrame:
    rows = w.driver_session_summary.filter(F.col("valid_laps") >= least_laps).select(
        "session_key", "driver_number", "driver_name", "team_name", "session_name",
        F.col("consistency_coefficient").alias("consistency"), "valid_laps",
        F.col("lap_time_stddev").alias("stddev"),
    )
    return _top(rows, 10, "consistency", "session_key", "driver_number")


def team_battle(w: Warehouse) -> DataFrame:
    return w.team_performance.filter("session_category = 'Race'").groupBy("team_name").agg(
        F.count("*").alias("sessions_participated"),
        F.avg("team_rank").alias("avg_rank"),
        F.min("team_rank").alias("best_rank"),
        C.mean("team_fastest_lap").alias("avg_fastest_lap"),
        C.mean("team_avg_consistency").alias("avg_consistency"),
    ).orderBy("avg_rank", "team_name")


def star_join_top_laps(w: Warehouse, category: str = "Qualifying") -> DataFrame:
    """Fastest valid laps of a category with session and driver, the first ten.

    Dimensions are filtered and cut to the needed columns before the joins.
    """
    sessions = w.dim_sessions.filter(F.col("session_category") == category).select(
        "session_dim_key", F.col("session_name").alias("session_title"), "location", "session_date"
    )
    drivers = w.dim_drivers.filter("is_current").select(
        "driver_key", F.col("full_name").alias("driver_name"), "team_name"
    )
    rows = (
        w.fact_laps.filter("is_valid_lap")
        .join(sessions, "session_dim_key")
        .join(drivers, "driver_key")
        .select("session_key", "driver_number", F.col("session_title").alias("session_name"),
                "location", "session_date", "driver_name", "team_name", "lap_number",
                "lap_duration", "is_valid_lap", "max_speed")
    )
    return _top(rows, 10, "lap_duration", "session_key", "driver_number", "lap_number")


def leaderboard_of(w: Warehouse, category: str = "Race") -> DataFrame:
    return w.session_leaderboard.filter(F.col("session_category") == category).select(
        "session_key", "position", "driver_name", "team_name", "fastest_lap_time",
        "delta_to_fastest", "gap_percentage", "is_top_3", "is_fastest_in_team",
    ).orderBy("position", "session_key")


def drivers_like(w: Warehouse, text: str) -> DataFrame:
    return w.driver_session_summary.filter(F.col("driver_name").contains(text)).select(
        "session_key", "session_name", "session_date", "driver_name", "team_name", "total_laps",
        "valid_laps", "fastest_lap_time", "avg_lap_time", "consistency_coefficient", "top_speed",
    ).orderBy(_desc("session_date"), "session_key", "driver_name")


def team_rankings(w: Warehouse, category: str = "Race") -> DataFrame:
    return w.team_performance.filter(F.col("session_category") == category).select(
        "session_key", "session_name", "session_date", "team_rank", "team_name", "drivers_count",
        "team_fastest_lap", "intra_team_gap", "team_avg_consistency",
    ).orderBy(_desc("session_date"), "team_rank", "session_key")


def fastest_lap_per_driver(w: Warehouse) -> DataFrame:
    laps = w.fact_laps.filter("is_valid_lap").groupBy("driver_number").agg(
        F.min("lap_duration").alias("fastest_lap")
    )
    rows = laps.join(
        w.dim_drivers.filter("is_current").select(
            "driver_number", F.col("full_name").alias("driver_name")
        ),
        "driver_number",
    )
    return _top(rows, 10, "fastest_lap", "driver_number")


def session_list(w: Warehouse) -> DataFrame:
    return w.dim_sessions.select(
        "session_key", "session_name", "location", "year", "session_category", "date_start"
    ).orderBy(_desc("date_start"), "session_key")


def newest_sessions(w: Warehouse, n: int = 5) -> DataFrame:
    rows = w.dim_sessions.select(
        "session_key", "session_name", "session_category", "session_date", "session_year"
    )
    return _top(rows, n, _desc("session_date"), _desc("session_key"))


def fastest_valid_laps(w: Warehouse, n: int = 10) -> DataFrame:
    rows = w.fact_laps.filter("is_valid_lap").select(
        "session_key", "driver_number", "lap_number", "lap_duration", "is_valid_lap"
    )
    return _top(rows, n, "lap_duration", "session_key", "driver_number", "lap_number")


def some_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows of a table, for a look at it."""
    return df.limit(n)


def driver_season_stats(w: Warehouse) -> DataFrame:
    return w.session_leaderboard.groupBy("driver_number", "driver_name", "year").agg(
        F.count_distinct("session_key").alias("sessions"),
        C.mean("fastest_lap_time").alias("avg_fastest_lap"),
        F.count_if(F.col("position") <= 3).alias("podiums"),
    )


def sector_distribution(w: Warehouse) -> DataFrame:
    return w.silver_laps.groupBy("sector_completeness").agg(F.count("*").alias("lap_count"))
