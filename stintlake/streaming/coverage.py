"""How telemetry covers the chunks of sessions, counted while points arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv
from stintlake.operators.chunks import numbered_points

#: How far behind the newest point another may come and still be counted.
DELAY = "1 hour"


def chunk_count_stream(
    points: DataFrame,
    sessions: DataFrame,
    target: str,
    checkpoint: str,
    by: Sequence[str] = ("driver_number",),
    delay: str = DELAY,
    every: str | None = None,
    minutes: int = fv.CHUNK_MINUTES,
    chunks: int = fv.CHUNK_COUNT,
    lead_minutes: int = fv.CHUNK_LEAD_MINUTES,
    edges: str = "half_open",
) -> StreamingQuery:
    """Count a stream of points per series and chunk, as they come, in a table of updates.

    Times are moved so that a window of the length of a chunk is a chunk of its session. The state holds one
    number for each series and window that the watermark, ``delay`` behind the newest point of the
    batches before, has not passed; points for older windows are dropped, and so are those without a time, a
    session or a key. A batch writes the windows that it changed to a folder of its own, which a retry
    overwrites. Read the counts with :func:`streamed_counts`; :func:`late_points` tells what was dropped.
    """
    keys = ["session_key", *by]
    numbered = numbered_points(points, sessions, minutes, chunks, lead_minutes, edges, aligned="_aligned")
    counts = (
        numbered.withWatermark("_aligned", delay).dropna(subset=keys)
        .groupBy(*keys, F.coalesce("chunk", F.lit(-1)).alias("chunk"), F.window("_aligned", f"{minutes} minutes"))
        .agg(F.count("*").alias("n"))
        .select(*keys, "chunk", F.col("window.start").alias("window_start"), "n")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        counts.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def streamed_counts(spark: SparkSession, target: str, by: Sequence[str] = ("driver_number",)) -> DataFrame:
    """``n`` points per series and chunk, -1 for points outside all chunks, after the first batch.

    A window's number only grows, so its largest is its latest.
    """
    keys = ["session_key", *by, "chunk"]
    latest = spark.read.parquet(target).groupBy(*keys, "window_start").agg(F.max("n").alias("n"))
    return latest.groupBy(*keys).agg(F.sum("n").alias("n"))


def late_points(
    points: DataFrame, sessions: DataFrame, counts: DataFrame, by: Sequence[str] = ("driver_number",)
) -> DataFrame:
    """Points that arrived, were counted and came too late, or to a session without a start, per series.

    ``points`` is the table at rest that the stream has read to its end.
    """
    keys = ["session_key", *by]
    arrived = (
        points.filter(C.parse_time("date").isNotNull()).dropna(subset=keys)
        .groupBy(*keys).agg(F.count("*").alias("arrived"))
        .join(sessions.select("session_key").distinct(), "session_key", "left_semi")
    )
    counted = counts.groupBy(*keys).agg(F.sum("n").alias("_n"))
    number = F.coalesce("_n", F.lit(0).cast("long"))
    return arrived.join(counted, keys, "left").select(
        *keys, "arrived", number.alias("counted"), (F.col("arrived") - number).alias("late")
    )
