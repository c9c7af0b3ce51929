"""Expressions over columns. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stintlake.functions import fixed_values as fv

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _any_of(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


# --- classification ---------------------------------------------------------


def classify(col: ColumnOrName, rules: Sequence[tuple], default: str) -> Column:
    """Label text by ordered word rules ``(label, include, exclude)``, ignoring case."""
    text = F.lower(_c(col))
    out = None
    for label, include, exclude in rules:
        test = _any_of(text, include)
        if exclude:
            test = test & ~_any_of(text, exclude)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(default)


def session_category(name: ColumnOrName) -> Column:
    return classify(name, fv.SESSION_CATEGORIES, fv.OTHER)


def team_category(team: ColumnOrName) -> Column:
    return classify(team, fv.TEAM_CATEGORIES, fv.OTHER)


def is_valid_lap(
    duration: ColumnOrName,
    pit_out: ColumnOrName,
    lo: float = fv.VALID_LAP_MIN,
    hi: float = fv.VALID_LAP_MAX,
) -> Column:
    """True for a timed lap within ``[lo, hi]`` that does not leave the pits; never NULL."""
    timed = F.coalesce(_c(duration).between(lo, hi), F.lit(False))
    return timed & ~F.coalesce(_c(pit_out), F.lit(False))


def sector_completeness(*sectors: ColumnOrName) -> Column:
    present = sum((_c(s).isNotNull().cast("int") for s in sectors), F.lit(0))
    return (
        F.when(present == len(sectors), fv.COMPLETE)
        .when(present == 0, fv.NO_SECTORS)
        .otherwise(fv.PARTIAL)
    )


def duration_check(category: ColumnOrName, minutes: ColumnOrName) -> Column:
    long_enough = [
        (_c(category) == label) & (_c(minutes) > least) for label, least in fv.MIN_SESSION_MINUTES
    ]
    return F.when(reduce(lambda a, b: a | b, long_enough), fv.STATUS_OK).otherwise(fv.STATUS_CHECK)


def lap_speed_class(duration: ColumnOrName, fast: float = 60, slow: float = 300) -> Column:
    d = _c(duration)
    return F.when(d < fast, fv.VERY_FAST).when(d > slow, fv.VERY_SLOW).otherwise(fv.NORMAL)


def count_status(actual: ColumnOrName, expected: ColumnOrName, share: float = 0.9) -> Column:
    a, e = _c(actual), _c(expected)
    return (
        F.when(a >= e.cast("double") * share, fv.COUNT_PASS)
        .when(a == 0, fv.COUNT_EMPTY)
        .otherwise(fv.COUNT_LOW)
    )


def equal_status(left: ColumnOrName, right: ColumnOrName) -> Column:
    return F.when(_c(left) == _c(right), fv.EQUAL_PASS).otherwise(fv.EQUAL_FAIL)


def flag(test: Column) -> Column:
    """A comparison as a flag: NULL counts as False."""
    return F.coalesce(test, F.lit(False))


# --- keys and text ----------------------------------------------------------


def surrogate_key(*cols: ColumnOrName) -> Column:
    """MD5 hex over the parts as text; a NULL part has its own mark.

    Parts are joined by a separator, so text that holds it can give one key to two rows:
    the key names rows with number keys, and is no test of equality.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(fv.KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(fv.KEY_SEPARATOR, *parts))


def mask_tail(col: ColumnOrName, keep: int = fv.MASK_KEEP, tail: str = fv.MASK_TAIL) -> Column:
    return F.concat(F.left(_c(col), F.lit(keep)), F.lit(tail))


def day_of(date_start: ColumnOrName) -> Column:
    """The part of an ISO time before ``T``; text without ``T``, or NULL, is ``unknown``."""
    text = _c(date_start)
    return F.when(text.contains("T"), F.split(text, "T")[0]).otherwise(fv.UNKNOWN_DAY)


def file_key(
    entity: ColumnOrName, day: ColumnOrName, location: ColumnOrName, session_name: ColumnOrName
) -> Column:
    """``{entity}_{day}_{location}_{session}``: blanks become ``_``, in the location also ``/``."""
    place = F.translate(F.coalesce(_c(location), F.lit(fv.UNKNOWN)), " /", "__")
    name = F.translate(F.coalesce(_c(session_name), F.lit(fv.UNKNOWN)), " ", "_")
    return F.concat_ws("_", _c(entity), _c(day), place, name)


# --- time -------------------------------------------------------------------


def parse_time(col: ColumnOrName) -> Column:
    """ISO text to timestamp; text that does not parse gives NULL, also under ANSI mode."""
    return F.try_to_timestamp(_c(col))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minutes from ISO text ``start`` to ``end``, two digits, NULL if either is unusable."""
    seconds = F.unix_timestamp(parse_time(end)) - F.unix_timestamp(parse_time(start))
    return F.round(seconds.cast("double") / F.lit(60.0), 2)


def calendar(date_start: ColumnOrName) -> dict[str, Column]:
    """Date parts of a session start (Sunday is day 1)."""
    ts = parse_time(date_start)
    return {
        "session_date": F.to_date(ts),
        "session_year": F.year(ts),
        "session_month": F.month(ts),
        "session_day_of_week": F.dayofweek(ts),
        "session_week_of_year": F.weekofyear(ts),
        "session_quarter": F.quarter(ts),
    }


def hours_since(ts: ColumnOrName, now: ColumnOrName) -> Column:
    return F.timestamp_diff("HOUR", _c(ts), _c(now))


# --- numbers ----------------------------------------------------------------


def zero_if_null(col: ColumnOrName) -> Column:
    return F.coalesce(_c(col), F.lit(0))


def sum_or_zero(*cols: ColumnOrName) -> Column:
    return reduce(lambda a, b: a + b, [zero_if_null(c) for c in cols])


def planar_distance(x: ColumnOrName, y: ColumnOrName) -> Column:
    xd, yd = _c(x).cast("double"), _c(y).cast("double")
    return F.sqrt(xd * xd + yd * yd)


def percent(part: ColumnOrName, whole: ColumnOrName, digits: int = 2) -> Column:
    """``part / whole * 100``; a zero whole gives NULL."""
    share = _c(part).cast("double") * F.lit(100.0) / F.nullif(_c(whole).cast("double"), F.lit(0.0))
    return F.round(share, digits)


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    return _c(a) / F.nullif(_c(b), F.lit(0.0))


def exact(col: ColumnOrName) -> Column:
    """A measurement as a decimal with 18 digits behind the point, to add up in any order.

    A sum of doubles changes in its last bits with the order in which tasks finish, which is
    enough to flip a later rounding. A sum of decimals does not, is partially aggregated
    before the shuffle, and raises under ANSI mode if a value or a sum passes 10^20.
    """
    return _c(col).cast("decimal(38,18)")


def mean_of(total: ColumnOrName, rows: ColumnOrName) -> Column:
    """The mean of measurements, from their exact sum and their number."""
    return _c(total).cast("double") / F.nullif(_c(rows), F.lit(0))


def mean(col: ColumnOrName) -> Column:
    """Average of measurements that does not depend on the order of rows."""
    return mean_of(F.sum(exact(col)), F.count(_c(col)))
