"""Change histories that are kept up as rows arrive, in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators.dedupe import latest_per_key
from stintlake.operators.scd import scd2_from_history
from stintlake.session import stage
from stintlake.sources.parts import BUCKETS, change_buckets, rows_in, touched_buckets
from stintlake.sources.writers import read_table

#: The tables of a history: one row per key and time, and the versions that come of them.
SEEN, VERSIONS = "observations", "versions"


def insert_history(
    path: str,
    rows: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    tie_break: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> list[int]:
    """Bring rows into the history below ``path``, late ones between those already there.

    Of rows with one key and time the first by ``tie_break`` descending stays, whichever load brought it,
    so any order of loads gives the versions of :func:`stintlake.operators.scd.scd2_from_history` over all rows,
    and a load may be repeated. A version alone does not tell when it was seen last, so what was seen is kept
    as well: a late row may divide a version, join two, or change nothing. Versions of keys in ``rows`` are made
    anew from what was seen of them; other keys of the same buckets are copied, other buckets are not touched.
    Rows without a key or a time are left out. Returns the buckets that were written.
    """
    spark = rows.sparkSession
    columns = list(dict.fromkeys([key, ts, *tracked, *tie_break]))
    order = [F.col(c).desc_nulls_last() for c in tie_break] or [F.col(ts)]

    def one_per_time(df: DataFrame) -> DataFrame:
        return latest_per_key(df.select(*columns), [key, ts], order, tracked)

    batch = stage(one_per_time(rows.dropna(subset=[key, ts])), "arrived")
    change_buckets(
        f"{path}/{SEEN}", batch, [key],
        lambda old, new: new if old is None else one_per_time(old.unionByName(new)), buckets,
    )
    keys = batch.select(key).distinct()
    touched = touched_buckets(keys, [key], buckets)

    def renewed(old: DataFrame | None, _: DataFrame) -> DataFrame:
        seen = rows_in(spark, f"{path}/{SEEN}", touched, buckets).join(keys, key, "left_semi")
        versions = scd2_from_history(seen, key, tracked, ts, tie_break)
        return versions if old is None else old.join(keys, key, "left_anti").unionByName(versions)

    return change_buckets(f"{path}/{VERSIONS}", batch, [key], renewed, buckets)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The versions of a history."""
    return read_table(spark, f"{path}/{VERSIONS}")
