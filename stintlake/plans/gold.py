"""Gold layer: two dimensions and the lap fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stintlake.functions import columns as C
from stintlake.operators.dedupe import latest_per_key
from stintlake.operators.grouping import sums_before

DRIVER_ATTRIBUTES = [
    "full_name", "broadcast_name", "name_acronym", "team_name", "team_colour",
    "team_category", "first_name", "last_name", "headshot_url", "country_code",
]


def build_dim_sessions(silver_sessions: DataFrame) -> DataFrame:
    """One row per session with calendar columns and category flags."""
    kinds = {"is_race": "Race", "is_qualifying": "Qualifying", "is_practice": "Practice",
             "is_sprint": "Sprint"}
    return silver_sessions.select(
        C.surrogate_key("session_key").alias("session_dim_key"),
        "session_key", "session_name", "session_type", "session_category",
        "date_start", "date_end", "session_duration_minutes", "gmt_offset", "meeting_key",
        "location", "country_key", "country_code", "country_name", "circuit_key",
        "circuit_short_name", "year",
        *[c.alias(n) for n, c in C.calendar("date_start").items()],
        *[C.flag(F.col("session_category") == k).alias(n) for n, k in kinds.items()],
        "updated_at",
    )


def build_dim_drivers(silver_drivers: DataFrame) -> DataFrame:
    """One current row per driver: the row updated last.

    ``updated_at`` is one value per build, so among a driver's sessions the row
    ingested last, then the highest session, decides.
    """
    newest = [
        F.col(c).desc_nulls_last() for c in ("updated_at", "_ingestion_timestamp", "session_key")
    ]
    return latest_per_key(silver_drivers, ["driver_number"], newest).select(
        C.surrogate_key("driver_number").alias("driver_key"),
        "driver_number",
        *DRIVER_ATTRIBUTES,
        F.col("updated_at").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def rank_laps(silver_laps: DataFrame, nulls: str = "first") -> DataFrame:
    """Add the lap sequence per driver, the lap-time rank per session and the personal best.

    Invalid and untimed laps take ranks too, but show none; untimed laps come first
    unless ``nulls="last"``. Laps of a session are ranked in slices, by whole second and within it by
    time and driver, so neither a session nor one lap time has to fit a task; the laps of one
    driver in one session are few, and need no slices. A finest slice lies within the laps of one
    driver: it brings its number of earlier laps along as one more row, which shares the only
    shuffle of whole laps, so laps are neither dealt by slice nor joined.
    """
    time, driver = F.col("lap_duration"), F.col("driver_number")
    # Total: rows that agree in all of these differ in no column that a rank shows.
    lap_order = [
        F.col("lap_number"), F.col("date_start").asc_nulls_first(), time, F.col("is_pit_out_lap"),
        F.col("updated_at"), F.col("speed_trap_speed"), F.col("max_speed"),
    ]
    missing = time.isNull() if nulls == "last" else time.isNotNull()
    sliced = silver_laps.select(
        "session_key", F.struct(missing, F.floor(time)).alias("_second"),
        F.struct(time, driver).alias("_time"),
    )
    one = F.lit(1).cast("long")
    slices = sums_before(sliced, ["session_key"], ["_second", "_time"], {"_earlier": one}).select(
        "session_key", "_time.*", "_earlier"
    )
    rows = silver_laps.withColumn("_lap", one).unionByName(slices, allowMissingColumns=True)
    upto = [Window.unboundedPreceding, 0]
    of_driver = Window.partitionBy("session_key", "driver_number")
    of_time = Window.partitionBy("session_key", "driver_number", "lap_duration")
    valid_time = F.when(F.col("is_valid_lap"), time)

    out = rows.select(
        "*",
        F.sum("_lap").over(of_driver.orderBy(*lap_order).rowsBetween(*upto)).alias("driver_lap_rank"),
        F.min(valid_time).over(of_driver).alias("driver_best_lap_time"),
    ).select(
        "*",
        F.sum("_lap").over(of_time.orderBy(*lap_order).rowsBetween(*upto)).alias("_local"),
        F.max("_earlier").over(of_time).alias("_before"),
    ).filter("_lap = 1")
    rank = F.when(F.col("is_valid_lap"), F.col("_before") + F.col("_local"))
    return out.withColumn("session_lap_time_rank", rank).drop(
        "_lap", "_earlier", "_local", "_before"
    )


#: What the fact table takes from the laps as it is; with these columns facts can be laps again.
LAP_COLUMNS = [
    "session_key", "meeting_key", "driver_number", "lap_number", "date_start",
    "lap_duration", "duration_sector_1", "duration_sector_2", "duration_sector_3",
    "calculated_lap_duration", "sector_duration_delta", "is_pit_out_lap", "is_valid_lap",
    "intermediate_1_speed", "intermediate_2_speed", "speed_trap_speed", "max_speed",
    "segments_sector_1", "segments_sector_2", "segments_sector_3", "sector_completeness",
]


def build_fact_laps(
    silver_laps: DataFrame, nulls: str = "first", carried: Sequence[str] = ()
) -> DataFrame:
    """One row per lap with keys, ranks and the gap to the driver's best lap, and ``carried`` columns.

    ``is_personal_best_lap`` compares times only, so an invalid lap that equals
    the best valid one is flagged as well.
    """
    return with_lap_keys(rank_laps(silver_laps, nulls), carried)


def with_lap_keys(ranked: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The fact table of ranked laps: what follows from a row alone. No shuffle."""
    best = F.col("driver_best_lap_time")
    return ranked.select(
        C.surrogate_key("session_key", "driver_number", "lap_number").alias("lap_key"),
        C.surrogate_key("session_key").alias("session_dim_key"),
        C.surrogate_key("driver_number").alias("driver_key"),
        *LAP_COLUMNS,
        "driver_lap_rank", "session_lap_time_rank", "driver_best_lap_time",
        F.when(F.col("is_valid_lap"), F.col("lap_duration") - best).alias(
            "delta_to_personal_best"
        ),
        C.flag(F.col("lap_duration") == best).alias("is_personal_best_lap"),
        "batch_day", "session_name", "updated_at", *carried,
    )
