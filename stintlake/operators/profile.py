"""Profiles and tolerant comparison of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions import columns as C


def profile(
    df: DataFrame,
    distinct: dict[str, str] | None = None,
    nulls: dict[str, str] | None = None,
    sums: dict[str, Column] | None = None,
    lows: dict[str, str] | None = None,
    highs: dict[str, str] | None = None,
    total: str = "total_records",
    by: Sequence[str] = (),
    reduce_first: bool = False,
) -> DataFrame:
    """Counts, distinct counts, NULL counts, sums and extremes, as one row (or one per group).

    For several exact distinct counts Spark repeats every row once per column.
    Where the distinct columns have few combinations for many rows (a session and
    driver hold many laps), ``reduce_first`` first brings the rows down to one per
    combination, with partial aggregation, so that only those are repeated.
    """
    distinct, nulls, sums = distinct or {}, nulls or {}, sums or {}
    lows, highs = lows or {}, highs or {}
    counts = {total: F.lit(1).cast("long")}
    counts |= {n: F.col(c).isNull().cast("long") for n, c in nulls.items()}
    counts |= sums
    # What the last step sums and takes the extremes of.
    added = {n: e for n, e in counts.items()}
    least = {n: F.col(c) for n, c in lows.items()}
    most = {n: F.col(c) for n, c in highs.items()}
    if reduce_first:
        combos = list(dict.fromkeys([*by, *distinct.values()]))
        df = df.groupBy(*combos).agg(
            *[F.sum(e).alias(f"_s_{n}") for n, e in added.items()],
            *[F.min(e).alias(f"_l_{n}") for n, e in least.items()],
            *[F.max(e).alias(f"_h_{n}") for n, e in most.items()],
        )
        added = {n: F.col(f"_s_{n}") for n in added}
        least = {n: F.col(f"_l_{n}") for n in least}
        most = {n: F.col(f"_h_{n}") for n in most}
    return df.groupBy(*by).agg(
        *[F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in added.items()],
        *[F.count_distinct(c).alias(n) for n, c in distinct.items()],
        *[F.min(e).alias(n) for n, e in least.items()],
        *[F.max(e).alias(n) for n, e in most.items()],
    )


def count_rows(tables: dict[str, DataFrame], extra: dict[str, dict] | None = None) -> DataFrame:
    """One row per table with its row count, plus literal columns per table."""
    extra = extra or {}
    parts = [
        df.agg(F.count("*").alias("record_count")).select(
            *[F.lit(v).alias(k) for k, v in extra.get(name, {}).items()],
            F.lit(name).alias("table_name"),
            "record_count",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    pairs: Sequence[tuple[str, str]],
    tolerance: float = 0,
) -> DataFrame:
    """Rows present on both sides whose paired columns differ by more than the tolerance."""
    joined = left.join(right, list(keys))
    if tolerance:
        tests = [F.abs(F.col(a) - F.col(b)) > tolerance for a, b in pairs]
    else:
        tests = [F.col(a) != F.col(b) for a, b in pairs]
    cols = [c for pair in pairs for c in pair]
    return joined.filter(reduce(lambda a, b: a | b, tests)).select(*keys, *cols)


def preservation(
    name: str, label: str, left: DataFrame, right: DataFrame, names: tuple[str, str],
    percent: bool = True,
) -> DataFrame:
    """Compare two one-row counts: difference and, if asked, share kept in percent."""
    a, b = names
    out = left.crossJoin(right).select(
        F.lit(label).alias(name), a, b, (F.col(b) - F.col(a)).alias("difference")
    )
    if percent:
        share = F.col(b).cast("double") / F.nullif(F.col(a), F.lit(0)) * 100
        out = out.withColumn("preservation_pct", F.round(share, 2))
    return out


def freshness(tables: dict[str, DataFrame], ts_col: str = "_ingestion_timestamp") -> DataFrame:
    """Latest and earliest load time and the rows of each table."""
    parts = [
        df.agg(
            F.max(ts_col).alias("latest_ingestion"),
            F.min(ts_col).alias("earliest_ingestion"),
            F.count("*").alias("records_count"),
        ).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def stale(fresh: DataFrame, now: str, limit_hours: int) -> DataFrame:
    """Whole hours since the last load, and an alert beyond the limit."""
    hours = C.hours_since("latest_ingestion", F.lit(now).cast("timestamp"))
    return fresh.select(
        "table_name", hours.alias("hours_stale"), (hours > limit_hours).alias("is_stale")
    )


def count_in_range(counts: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Whether the row count of each listed table lies in its range."""
    lo = hi = None
    for name, (low, high) in ranges.items():
        here = F.col("table_name") == name
        lo = F.when(here, low) if lo is None else lo.when(here, low)
        hi = F.when(here, high) if hi is None else hi.when(here, high)
    return counts.filter(F.col("table_name").isin(list(ranges))).select(
        "table_name", "record_count", lo.alias("min_count"), hi.alias("max_count"),
        F.col("record_count").between(lo, hi).alias("in_range"),
    )
