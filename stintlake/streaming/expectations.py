"""Row expectations: drop or track, with counts observed while the data flows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = "expectations"

# Expectations on laps and locations.
LAPS_DROP = {
    "valid_session_key": "session_key IS NOT NULL",
    "valid_driver_number": "driver_number IS NOT NULL",
}
LAPS_TRACK = {"valid_lap_duration": "lap_duration > 0 OR lap_duration IS NULL"}
LOCATIONS_DROP = {"valid_coordinates": "x IS NOT NULL AND y IS NOT NULL"}


def _holds(predicate: str):
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_drop(df: DataFrame, name: str, predicate: str) -> DataFrame:
    """Remove rows that do not meet the predicate; NULL does not meet it."""
    return df.filter(_holds(predicate))


def expect_track(df: DataFrame, name: str, predicate: str) -> DataFrame:
    """Keep all rows and observe how many do not meet the predicate."""
    return df.observe(name, F.count_if(~_holds(predicate)).alias(name))


def with_expectations(
    df: DataFrame, drop: dict[str, str], track: dict[str, str], metrics: str = METRICS
) -> DataFrame:
    """Observe violations of all expectations over the incoming rows, then drop.

    The counts appear in the query progress of a stream, or through a listener in
    a batch; they cost no extra pass.
    """
    failed = [
        F.count_if(~_holds(p)).alias(n) for n, p in {**drop, **track}.items()
    ]
    out = df.observe(metrics, F.count("*").alias("rows"), *failed)
    return out.filter(reduce(lambda a, b: a & b, [_holds(p) for p in drop.values()], F.lit(True)))


def expectation_counts(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """Passed and failed rows per expectation, in one pass over a table at rest."""
    counted = df.agg(
        F.count("*").alias("_n"),
        *[F.count_if(~_holds(p)).alias(f"_{n}") for n, p in expectations.items()],
    )
    rows = [
        F.struct(
            F.lit(n).alias("expectation"),
            (F.col("_n") - F.col(f"_{n}")).alias("passed_records"),
            F.col(f"_{n}").alias("failed_records"),
        )
        for n in expectations
    ]
    return counted.select(F.inline(F.array(*rows)))


def laps_quality(laps: DataFrame) -> DataFrame:
    return with_expectations(laps, LAPS_DROP, LAPS_TRACK)


def locations_quality(locations: DataFrame) -> DataFrame:
    return with_expectations(locations, LOCATIONS_DROP, {})
