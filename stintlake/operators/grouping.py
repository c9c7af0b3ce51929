"""Ranking and running totals within groups, whatever the size of a group.

A plain window sends all rows of a group to one task. That is the best plan where keys bound a
group, and no plan at all once one session or driver holds a third of a large table. So a
caller whose groups are not bounded names slices, from coarse to fine: expressions that rise with the
order, such as the whole second of a lap time and then the time itself with the driver, or the
day of a start and then its second. A window covers the rows of one finest slice. The totals of earlier
slices, one row per group and slice, are added up level by level, so that a window of theirs covers
the slices within the next coarser one only: seconds of a day, days of a group. Slices follow
the values down to single ones, wherever rows crowd, and the number of values at a level bounds every
window above the finest. There is one way for groups of any size, in one lazy plan; nothing runs
while it is built, and all parts of it agree, since slices depend on the row alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

def _sliced(df: DataFrame, slices: Column | Sequence[Column]) -> tuple[DataFrame, list[str]]:
    levels = [slices] if isinstance(slices, Column) else list(slices)
    names = [f"_slice{i}" for i in range(len(levels))]
    return df.withColumns(dict(zip(names, levels))), names


def join_same(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on NULL-safe equality of the keys; the keys of the left side remain.

    The right keys are renamed first, so both sides may come from one frame.
    """
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    slices: Column | Sequence[Column] | None = None,
) -> DataFrame:
    """Add, per output name, the sum of an expression over the group up to the row.

    ``order`` should be total within a group; rows that tie are numbered in any order.
    ``slices`` must never fall along ``order`` (NULL is lowest), each level within the one before. They
    may be left out only if keys bound the rows of a group.
    """
    upto = [Window.unboundedPreceding, 0]
    if slices is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.select("*", *[F.sum(e).over(window).alias(n) for n, e in sums.items()])
    sliced, names = _sliced(df, slices)
    window = Window.partitionBy(*keys, *names).orderBy(*order).rowsBetween(*upto)
    local = sliced.select("*", *[F.sum(e).over(window).alias(f"_l_{n}") for n, e in sums.items()])
    offsets = sums_before(sliced, keys, names, sums).withColumnsRenamed({n: f"_o_{n}" for n in sums})
    return join_same(local, offsets, [*keys, *names]).select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums]
    )


def sums_before(
    df: DataFrame, keys: Sequence[str], names: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """One row per group and slice: the sums of all earlier slices of the group.

    ``names`` are the columns of the slices, from coarse to fine.
    """
    totals = df.groupBy(*keys, *names).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    return _before(totals, keys, names, list(sums))


def _before(
    totals: DataFrame, keys: Sequence[str], names: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """For each slice the sums of all earlier slices of its group, under the same names."""
    *outer, inner = names
    earlier = Window.partitionBy(*keys, *outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    own = totals.select(
        *keys, *names, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums]
    )
    if not outer:
        return own
    whole = totals.groupBy(*keys, *outer).agg(*[F.sum(n).alias(n) for n in sums])
    above = _before(whole, keys, outer, sums).withColumnsRenamed({n: f"_a_{n}" for n in sums})
    return join_same(own, above, [*keys, *outer]).select(
        *keys, *names, *[(F.col(n) + F.col(f"_a_{n}")).alias(n) for n in sums]
    )


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "row_number",
    slices: Column | Sequence[Column] | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 in the given order; see :func:`running_sums`."""
    if slices is None:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(name, number.cast("long"))
    return running_sums(df, keys, order, {name: F.lit(1).cast("long")}, slices)


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    ties: str = "row_number",
    tie_break: Sequence[str] = (),
    nulls: str = "first",
    name: str = "rank",
) -> DataFrame:
    """Rank rows of a group by a number, smallest first.

    ``ties``: ``row_number`` (the tie-break decides), ``rank`` (equal measures share
    the lowest number) or ``dense_rank`` (as ``rank``, without gaps). Slices are the whole
    part of the measure, and within it the measure with the first tie-break.
    """
    col = F.col(measure)
    first = col.asc_nulls_first() if nulls == "first" else col.asc_nulls_last()
    missing = col.isNull() if nulls == "last" else col.isNotNull()
    whole = F.floor(col)
    if ties == "row_number":
        order = [first, *[F.col(c) for c in tie_break]]
        finer = F.struct(col, *[F.col(c) for c in tie_break[:1]])
        return row_numbers(df, keys, order, name, [F.struct(missing, whole), finer])
    # Ranks of ties depend on the measure alone: rank the distinct values, join back.
    values = df.groupBy(*keys, measure).agg(F.count("*").alias("_rows"))
    add = F.col("_rows") if ties == "rank" else F.lit(1).cast("long")
    placed = running_sums(values, keys, [first], {"_upto": add}, F.struct(missing, whole))
    own = F.col("_rows") if ties == "rank" else F.lit(1)
    placed = placed.select(*keys, measure, (F.col("_upto") - own + 1).alias(name))
    return join_same(df, placed, [*keys, measure])


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    slices: Column | Sequence[Column] | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add values of the preceding row of the group: ``{new name: column}``.

    ``order`` must be total within a group (NULL is lowest); ``slices`` as in
    :func:`running_sums`. The first row of a slice takes the last row of the slice before.
    """
    forth = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    if slices is None:
        window = Window.partitionBy(*keys).orderBy(*forth)
        return df.select("*", *[F.lag(c).over(window).alias(n) for n, c in values.items()])
    sliced, names = _sliced(df, slices)
    window = Window.partitionBy(*keys, *names).orderBy(*forth)
    both = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    local = sliced.select(
        "*", F.row_number().over(window).alias("_n"), F.lag(both).over(window).alias("_p")
    )
    pick = F.min_by if descending else F.max_by
    ends = sliced.groupBy(*keys, *names).agg(pick(both, F.struct(*order)).alias("_end"))
    return join_same(local, _entering(ends, keys, names), [*keys, *names]).select(
        *df.columns,
        *[F.when(F.col("_n") == 1, F.col(f"_before.{n}")).otherwise(F.col(f"_p.{n}")).alias(n) for n in values],
    )


def _entering(ends: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """For each slice, as ``_before``, the ``_end`` of the slice before it in its group."""
    *outer, inner = names
    rising = Window.partitionBy(*keys, *outer).orderBy(inner)
    own = ends.select(*keys, *names, F.lag("_end").over(rising).alias("_before"))
    if not outer:
        return own
    # The first slice within a coarser one takes the end of the coarser one before.
    last = ends.groupBy(*keys, *outer).agg(F.max_by("_end", F.struct(inner)).alias("_end"))
    above = _entering(last, keys, outer).withColumnRenamed("_before", "_above")
    return join_same(own, above, [*keys, *outer]).select(
        *keys, *names, F.coalesce("_before", "_above").alias("_before")
    )


def with_group_value(
    df: DataFrame, keys: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Add an aggregate of the row's group to the row.

    The aggregate is reduced before its shuffle and joined back, so no task holds
    a whole group: a small result is broadcast by size, otherwise the skew join
    of adaptive execution splits large groups.
    """
    return join_same(df, df.groupBy(*keys).agg(value.alias(name)), keys, "left")
