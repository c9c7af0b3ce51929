"""Session selection and the stamping of child records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv
from stintlake.operators.dedupe import latest_per_key


def select_sessions(
    sessions: DataFrame,
    mode: str = "latest",
    n: int = 1,
    year: int | None = None,
    days: Sequence[str] = fv.MANUAL_DAYS,
    session_type: str | None = None,
) -> DataFrame:
    """Choose sessions: ``latest`` n, ``oldest`` n, all of a ``year``, or ``manual`` days.

    A missing start sorts as empty text, that is, as the oldest. ``session_type``
    keeps one type, before any limit.
    """
    start = F.coalesce("date_start", F.lit(""))
    newest = [start.desc(), F.col("session_key").desc()]
    out = sessions if year is None else sessions.filter(F.col("year") == year)
    if session_type is not None:
        out = out.filter(F.col("session_type") == session_type)
    if mode == "year":
        return out
    if mode == "manual":
        return out.filter(C.day_of("date_start").isin(list(days)))
    if mode == "latest":
        return out.orderBy(*newest).limit(n)
    if mode == "oldest":
        return out.orderBy(start.asc(), F.col("session_key").asc()).limit(n)
    raise ValueError(f"unknown mode {mode!r}")


def recent_sessions(sessions: DataFrame, year: int, limit: int = 20) -> DataFrame:
    return select_sessions(sessions, "latest", limit, year)


def race_sessions(sessions: DataFrame, year: int, limit: int = 10) -> DataFrame:
    """The newest races of a year, whatever other sessions it has."""
    return select_sessions(sessions, "latest", limit, year, session_type="Race")


def stamp_children(children: DataFrame, sessions: DataFrame, entity: str = "laps") -> DataFrame:
    """Give child records the session name, day and output key of their session.

    Every child stays, once: one without a session is stamped ``unknown``, and of a session
    listed several times the row that starts last, then the first by name, counts.
    """
    order = [F.col("date_start").desc_nulls_last()]
    one = latest_per_key(
        sessions.select("session_key", "date_start", "session_name", "location"),
        ["session_key"], order, ["session_name", "location"],
    ).select(
        "session_key", F.col("date_start").alias("_start"), F.col("session_name").alias("_name"),
        F.col("location").alias("_place"),
    )
    day = C.day_of("_start")
    return children.drop("session_name", "batch_day").join(one, "session_key", "left").withColumns({
        "session_name": F.coalesce("_name", F.lit(fv.UNKNOWN)),
        "batch_day": day,
        "file_key": C.file_key(F.lit(entity), day, "_place", "_name"),
    }).drop("_start", "_name", "_place")
