"""Time chunks of sessions and how telemetry covers them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv


def chunk_plan(
    sessions: DataFrame,
    minutes: int = fv.CHUNK_MINUTES,
    chunks: int = fv.CHUNK_COUNT,
    lead_minutes: int = fv.CHUNK_LEAD_MINUTES,
) -> DataFrame:
    """``chunks`` equal chunks per session, from ``lead_minutes`` before its start."""
    first = F.timestamp_add("MINUTE", F.lit(-lead_minutes), C.parse_time("date_start"))
    return (
        sessions.select("session_key", first.alias("_first"))
        .filter("_first IS NOT NULL")
        .select("session_key", "_first", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
        .select(
            "session_key",
            "chunk",
            F.timestamp_add("MINUTE", F.col("chunk") * minutes, F.col("_first")).alias("chunk_start"),
            F.timestamp_add("MINUTE", (F.col("chunk") + 1) * minutes, F.col("_first")).alias("chunk_end"),
        )
    )


def points_in_chunks(
    points: DataFrame,
    sessions: DataFrame,
    minutes: int = fv.CHUNK_MINUTES,
    chunks: int = fv.CHUNK_COUNT,
    lead_minutes: int = fv.CHUNK_LEAD_MINUTES,
    edges: str = "half_open",
) -> DataFrame:
    """Points with the number of their chunk; points outside all chunks are left out.

    No range join: one equality join on the session, then arithmetic. A point on
    the start of a chunk belongs to it; with ``edges="open"`` to none.
    """
    numbered = numbered_points(points, sessions, minutes, chunks, lead_minutes, edges)
    return numbered.filter("chunk IS NOT NULL")


def numbered_points(
    points: DataFrame,
    sessions: DataFrame,
    minutes: int,
    chunks: int,
    lead_minutes: int,
    edges: str,
    aligned: str | None = None,
) -> DataFrame:
    """Points that have a session, with their chunk; NULL outside all chunks.

    ``aligned`` names a column for the time of a point, moved back so that chunks of its session begin
    at full multiples of their length: a plain time window of that length is then one chunk.
    """
    first = sessions.select(
        "session_key",
        F.timestamp_add("MINUTE", F.lit(-lead_minutes), C.parse_time("date_start")).alias("_first"),
    )
    width = minutes * 60_000_000
    since = F.unix_micros(C.parse_time("date")) - F.unix_micros("_first")
    inside = (F.col("_since") >= 0) & (F.col("_since") < width * chunks)
    if edges == "open":
        inside = inside & (F.col("_since") % width != 0)
    joined = points.join(first, "session_key")
    if aligned:
        moved = F.unix_micros(C.parse_time("date")) - F.pmod(F.unix_micros("_first"), F.lit(width))
        joined = joined.withColumn(aligned, F.timestamp_micros(moved))
    return (
        joined.withColumn("_since", since)
        .withColumn("chunk", F.when(inside, F.floor(F.col("_since") / width).cast("int")))
        .drop("_first", "_since")
    )


def chunk_coverage(
    sessions: DataFrame,
    points: DataFrame,
    by: Sequence[str] = ("driver_number",),
    stop_after: int = fv.CHUNK_STOP_AFTER,
    minutes: int = fv.CHUNK_MINUTES,
    chunks: int = fv.CHUNK_COUNT,
    lead_minutes: int = fv.CHUNK_LEAD_MINUTES,
    edges: str = "half_open",
) -> DataFrame:
    """Points per chunk, and whether a reader that stops after ``stop_after`` empty
    chunks in a row would still ask for the chunk.

    One pass over the points counts them per series and chunk. A series is then a
    row with at most one count per chunk, so nothing below grows with a session.
    """
    keys = ["session_key", *by]
    counts = (
        numbered_points(points, sessions, minutes, chunks, lead_minutes, edges)
        .dropna(subset=keys)
        .groupBy(*keys, F.coalesce("chunk", F.lit(-1)).alias("chunk"))
        .agg(F.count("*").alias("n"))
    )
    return coverage_of_counts(sessions, counts, by, stop_after, minutes, chunks, lead_minutes)


def coverage_of_counts(
    sessions: DataFrame,
    counts: DataFrame,
    by: Sequence[str] = ("driver_number",),
    stop_after: int = fv.CHUNK_STOP_AFTER,
    minutes: int = fv.CHUNK_MINUTES,
    chunks: int = fv.CHUNK_COUNT,
    lead_minutes: int = fv.CHUNK_LEAD_MINUTES,
) -> DataFrame:
    """The coverage from ``n`` points per series and chunk, -1 for points outside all chunks."""
    keys = ["session_key", *by]
    plan = chunk_plan(sessions, minutes, chunks, lead_minutes)
    series = counts.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("chunk", "n"))).alias("_counts")
    )
    # Without further keys a session is listed even if it has no points.
    rows = plan.join(series, "session_key", "inner" if by else "left").select(
        *keys, "chunk", "chunk_start", "chunk_end",
        F.coalesce(F.col("_counts")[F.col("chunk")], F.lit(0).cast("long")).alias("points"),
    )
    ordered = Window.partitionBy(*keys).orderBy("chunk")
    recent = ordered.rowsBetween(-(stop_after - 1), 0)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    empty_run = (F.max("points").over(recent) == 0) & (F.count("*").over(recent) == stop_after)
    return (
        rows.withColumn("_stop", empty_run)
        .withColumn("is_read", ~F.coalesce(F.max("_stop").over(earlier), F.lit(False)))
        .drop("_stop")
    )
