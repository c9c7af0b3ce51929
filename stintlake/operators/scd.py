"""Validity intervals: snapshots, change history, lookups and overlap checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stintlake.functions import columns as C
from stintlake.operators.dedupe import latest_per_key
from stintlake.operators.grouping import running_sums, with_previous
from stintlake.session import stage

FOREVER = "9999-12-31"
#: Versions of one key and month that an as-of lookup holds together.
PAGE = 1024


def snapshot(
    current: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    run_ts: str,
    hard_deletes: bool = True,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The next state of a snapshot table.

    A key seen first, or seen with a newer ``updated_at``, opens a version; the
    version it replaces is closed at that time. With ``hard_deletes`` an open
    version whose key left the source is closed at ``run_ts``. The source need
    not be unique on the key: its newest row counts. One full join on the key,
    unique on both sides, serves all cases.
    """
    rows = latest_per_key(
        source.filter(F.col(key).isNotNull()), [key], [F.col(updated_at).desc_nulls_last()], tie_break
    )
    cols = rows.columns
    opened = rows.select(
        C.surrogate_key(key, updated_at).alias("scd_id"),
        *cols,
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    if current is None:
        return opened
    all_cols = opened.columns
    closed = current.filter("valid_to IS NOT NULL").select(*all_cols)
    old = current.filter("valid_to IS NULL").select(F.struct(*all_cols).alias("_old"))
    new = opened.select(F.struct(*all_cols).alias("_new"))
    pairs = old.join(new, F.col(f"_old.{key}") == F.col(f"_new.{key}"), "full")

    newer = F.col(f"_new.{updated_at}") > F.col("_old.valid_from")
    gone = F.col("_new").isNull() & F.lit(hard_deletes)
    ended = (
        F.when(F.col("_old").isNotNull() & newer, F.col(f"_new.{updated_at}"))
        .when(gone, F.lit(run_ts).cast("timestamp"))
    )
    kept = F.when(F.col("_old").isNotNull(), F.col("_old").withField("valid_to", ended))
    added = F.when(F.col("_old").isNull() | newer, F.col("_new"))
    versions = pairs.select(F.inline(F.array_compact(F.array(kept, added))))
    return closed.unionByName(versions)


def _times(ts: str, sign: int = 1) -> list[Column]:
    """The day and the second of a time as numbers that rise (or fall) with it: slices of a history."""
    return [F.lit(sign) * F.unix_date(F.to_date(ts)), F.lit(sign) * F.unix_seconds(ts)]


def _month(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def scd2_from_history(
    df: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Versions with closed intervals: one per run of equal tracked attributes of a key.

    Rows are first reduced to one per key and time. Attributes are compared column by column,
    NULL equal to NULL. A version lasts until the next one starts; the last is current. The rows
    at which something changes are written once before their ends are looked up.
    """
    rows = latest_per_key(
        df.dropna(subset=[key, ts]),
        [key, ts],
        [F.col(c).desc_nulls_last() for c in tie_break] or [F.col(ts)],
        tracked,
    ).select(key, F.col(ts).alias("valid_from"), F.struct(*tracked).alias("_state"))
    seen = with_previous(
        rows, [key], ["valid_from"], {"_before_state": "_state"}, _times("valid_from")
    )
    changes = seen.filter(~F.col("_before_state").eqNullSafe(F.col("_state"))).drop("_before_state")
    changes = stage(changes, "history")  # few rows of many, needed several times
    ended = with_previous(
        changes, [key], ["valid_from"], {"valid_to": "valid_from"}, _times("valid_from", -1),
        descending=True,
    )
    return ended.select(
        key, *[F.col(f"_state.{c}").alias(c) for c in tracked], "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    fact_ts: str,
    from_col: str = "valid_from",
    to_col: str = "valid_to",
) -> DataFrame:
    """Facts with the dimension rows valid at their time (both ends included).

    Versions are laid out once for each month that they cover, up to the month of the last fact, and
    those of a key and month are held together in time order, ``PAGE`` at a time. A fact asks for the
    versions of its key and month, so facts are read once beside the search for their last month and are
    never sorted, and a key with very many facts is split like any skewed join.
    """
    attributes = [c for c in dim.columns if c != key]
    until = F.coalesce(F.col(to_col), F.lit(FOREVER).cast("timestamp"))
    last = fact.agg(F.max(_month(F.col(fact_ts)))).scalar()
    covered = dim.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(from_col).alias("_from"), until.alias("_to"),
        F.struct(*attributes).alias("_version"), _month(F.col(from_col)).alias("_first"),
        F.least(_month(until), last).alias("_last"),
    ).filter("_first <= _last")
    months = covered.withColumn("_at_month", F.explode(F.sequence("_first", "_last")))
    place = F.row_number().over(Window.partitionBy("_key", "_at_month").orderBy("_from"))
    pages = months.withColumn("_page", F.floor(place / PAGE)).groupBy("_key", "_at_month", "_page").agg(
        F.min("_from").alias("_low"), F.max("_to").alias("_high"),
        F.collect_list(F.struct("_from", "_to", "_version")).alias("_versions"),
    )
    facts = fact.filter(F.col(key).isNotNull()).select(
        F.struct(*fact.columns).alias("_fact"), F.col(key).alias("_fact_key"),
        F.col(fact_ts).alias("_time"), _month(F.col(fact_ts)).alias("_fact_month"),
    )
    on = (
        (F.col("_fact_key") == F.col("_key")) & (F.col("_fact_month") == F.col("_at_month"))
        & F.col("_time").between(F.col("_low"), F.col("_high"))
    )
    valid = F.filter("_versions", lambda v: F.col("_time").between(v["_from"], v["_to"]))
    return facts.join(pages, on).select("_fact", F.explode(valid).alias("_match")).select(
        *[F.col(f"_fact.{c}").alias(c) for c in [key, *[c for c in fact.columns if c != key]]],
        *[F.col(f"_match._version.{c}").alias(c) for c in attributes],
    )


def version_overlaps(
    dim: DataFrame,
    key: str,
    until: str,
    from_col: str = "valid_from",
    to_col: str = "valid_to",
) -> DataFrame:
    """Intervals that overlap others of their key, with the number of others.

    ``until`` ends open intervals. No pairs are formed: the others that start
    before my end, less those that end by my start, are the overlapping ones, and
    both come from running counts over the sorted interval ends. Intervals that
    do not end after their start are left to :func:`interval_order_errors`.
    """
    end = F.coalesce(F.col(to_col), F.lit(until).cast("timestamp"))
    rows = dim.select(key, F.col(from_col).alias("_s"), end.alias("_e")).filter("_s < _e")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    # Equal intervals of a key share their ends, so they are counted as one row.
    spans = rows.groupBy(key, "_s", "_e").agg(F.count("*").alias("_n"))
    ends = spans.select(key, "_s", "_e", "_n", F.col("_e").alias("_t"), zero.alias("_kind"))
    starts = spans.select(key, "_s", "_e", "_n", F.col("_s").alias("_t"), one.alias("_kind"))
    running = running_sums(
        ends.unionByName(starts),
        [key],
        [F.col(c) for c in ("_t", "_kind", "_s", "_e")],
        {
            "_starts": F.when(F.col("_kind") == 1, F.col("_n")).otherwise(zero),
            "_ends": F.when(F.col("_kind") == 0, F.col("_n")).otherwise(zero),
        },
        [
            F.unix_date(F.to_date("_t")), F.struct("_t", "_kind"),
            F.unix_date(F.to_date(F.when(F.col("_kind") == 1, F.col("_e")).otherwise(F.col("_s")))),
        ],
    )
    # At an end, all starts before it are counted; at a start, all ends up to it.
    return (
        running.groupBy(key, "_s", "_e")
        .agg(
            F.max("_n").alias("versions"),
            (F.max(F.when(F.col("_kind") == 0, F.col("_starts")))
             - F.max(F.when(F.col("_kind") == 1, F.col("_ends"))) - 1).alias("overlaps"),
        )
        .filter("overlaps > 0")
        .select(key, F.col("_s").alias(from_col), F.col("_e").alias(to_col), "versions", "overlaps")
    )


def interval_order_errors(dim: DataFrame) -> DataFrame:
    """Closed versions that do not end after their start, and current ones that end."""
    backwards = (~F.col("is_current")) & (F.col("valid_from") >= F.col("valid_to"))
    ended = F.col("is_current") & F.col("valid_to").isNotNull()
    issue = F.when(backwards, "valid_from >= valid_to for historical record").when(
        ended, "Current record has non-NULL valid_to"
    )
    return dim.withColumn("issue", issue).filter("issue IS NOT NULL")
