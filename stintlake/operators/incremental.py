"""Incremental loads: high-water mark and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "_ingestion_timestamp"


def high_water_mark(target: DataFrame | None, ts_col: str = MARK):
    """The largest value of the column, or ``None`` for a missing or empty target."""
    return None if target is None else target.agg(F.max(ts_col)).first()[0]


def incremental_read(
    source: DataFrame, target: DataFrame | None, ts_col: str = MARK
) -> DataFrame:
    """Source rows newer than everything in the target; all of them if it is empty.

    The mark is one value and enters the plan as a literal, so it is pushed to the scan.
    """
    mark = high_water_mark(target, ts_col)
    return source if mark is None else newer_than(source, mark, ts_col)


def newer_than(source: DataFrame, mark, ts_col: str = MARK) -> DataFrame:
    return source.filter(F.col(ts_col) > F.lit(mark))


def merge_upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    update_all: bool = False,
    report: bool = False,
) -> DataFrame:
    """Rows of the target after a merge with a batch that is unique on the keys.

    The result has the columns of both sides. A column that only the batch has is taken from
    it and NULL in other rows; one that only the target has keeps its values.

    Matched rows take the ``update_cols`` of the batch and keep the rest, so
    derived columns and the ingestion time of an updated row stay as they were.
    ``update_all=True`` takes every column, which also moves the high-water mark.
    ``report=True`` adds what happened to each row.
    """
    if target is None:
        return batch.withColumn("_merge", F.lit("inserted")) if report else batch
    added = [c for c in batch.columns if c not in target.columns]
    cols = [*target.columns, *added]
    update = {*(batch.columns if update_all else update_cols), *added}
    missing = F.lit(None)
    old = target.select(
        *[(F.col(c) if c in target.columns else missing.cast(batch.schema[c].dataType)).alias(f"_t_{c}")
          for c in cols], F.lit(True).alias("_old"),
    )
    new = batch.select(
        *[(F.col(c) if c in batch.columns else missing.cast(target.schema[c].dataType)).alias(f"_b_{c}")
          for c in cols], F.lit(True).alias("_new"),
    )
    on = [F.col(f"_t_{k}") == F.col(f"_b_{k}") for k in keys]
    both = old.join(new, on, "full")
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def merged(c: str):
        before, after = F.col(f"_t_{c}"), F.col(f"_b_{c}")
        known = c in update and c in batch.columns
        take_new = F.col("_new").isNotNull() if known else F.col("_old").isNull()
        return F.when(take_new, after).otherwise(before).alias(c)

    action = (
        F.when(matched, "updated").when(F.col("_old").isNull(), "inserted").otherwise("kept")
    )
    return both.select(*[merged(c) for c in cols], *([action.alias("_merge")] if report else []))
