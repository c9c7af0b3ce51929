"""Tables in parts, of which a change rewrites those that it touches.

The current state is a list of folders (:func:`stintlake.sources.writers.replace_parts`). A change
writes new folders for the parts it touches and then names them together with the untouched ones, in
one step: whoever stops before leaves the table as it was, and files of other parts stay the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.session import stage
from stintlake.sources.writers import (
    DIVIDED,
    KEY_BUCKET,
    current_parts,
    list_names,
    new_version,
    next_pointer,
    read_folders,
    replace_parts,
    version_path,
)

BUCKETS = 16


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The number of the bucket in which a row lies."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def read_parts(spark: SparkSession, folders: Sequence[str]) -> DataFrame | None:
    """The rows of some parts of a table, or ``None`` of none."""
    return read_folders(spark.read.option("mergeSchema", True), folders) if folders else None


def touched_buckets(rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> set[int]:
    """The buckets that rows fall into: at most ``buckets`` numbers, whatever the rows."""
    return {r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect()}


def in_buckets(spark: SparkSession, path: str, buckets: int) -> bool:
    """Whether a table stands there that is kept in that many buckets."""
    stored = current_parts(spark, path)
    return bool(stored) and all(label.split("/")[0] == str(buckets) for label, _ in stored)


def rows_in(spark: SparkSession, path: str, touched: set[int], buckets: int) -> DataFrame:
    """The rows of some buckets of a table; files of the others are not opened."""
    stored = current_parts(spark, path) or []
    labels = {f"{buckets}/{b}" for b in touched}
    rows = read_parts(spark, [folder for label, folder in stored if label in labels])
    return rows if rows is not None else read_parts(spark, [stored[0][1]]).limit(0)


def change_buckets(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    change: Callable[[DataFrame | None, DataFrame], DataFrame],
    buckets: int = BUCKETS,
    fresh: bool = False,
) -> list[int]:
    """Rewrite the key buckets that a batch falls into; returns their numbers.

    A row lies in the bucket of the hash of its keys. ``change`` gets the stored rows of the touched
    buckets (``None`` if there are none) and the batch, and returns what is to stand there. The
    driver sees numbers of buckets only, at most ``buckets`` of them, which is fixed for a table.
    With ``fresh`` the batch replaces the whole table.
    """
    spark = batch.sparkSession
    number = next_pointer(spark, path)
    touched = touched_buckets(batch, keys, buckets)
    return rewrite_buckets(
        spark, path, touched, keys, lambda old: change(old, batch), buckets, fresh, number=number
    )


def rewrite_buckets(
    spark: SparkSession,
    path: str,
    touched: set[int],
    keys: Sequence[str],
    change: Callable[[DataFrame | None], DataFrame],
    buckets: int = BUCKETS,
    fresh: bool = False,
    partition_by: Sequence[str] = (),
    number: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> list[int]:
    """Rewrite the buckets with the given numbers; see :func:`change_buckets`.

    ``partition_by`` names columns by whose values a bucket is divided into folders. ``number`` is that of
    the next state, if it was asked for before. ``finish`` adds, row by row, columns that follow from the
    others, after rows are dealt to files, so that they are not shuffled.
    """
    finish = finish or (lambda rows: rows)
    number = next_pointer(spark, path) if number is None else number
    stored = [] if fresh else current_parts(spark, path) or []
    if not touched and stored:
        return []
    labels = {f"{buckets}/{b}" for b in touched}
    strange = [label for label, _ in stored if label.split("/")[0] != str(buckets)]
    if strange:
        raise ValueError(f"{path} is not kept in {buckets} buckets")
    old = read_parts(spark, [folder for label, folder in stored if label in labels])
    version = f"{DIVIDED}v{new_version()}" if partition_by else new_version()
    rows, places = change(old), [KEY_BUCKET, *partition_by]
    placed = rows.withColumn(KEY_BUCKET, bucket_of(keys, buckets)).hint("rebalance", *places)
    finish(placed).withColumn(KEY_BUCKET, bucket_of(keys, buckets)).write.mode(
        "errorifexists"
    ).partitionBy(*places).parquet(version_path(path, version))
    folder = version_path(path, version)
    written = [n for n in list_names(spark, folder) if n.startswith(f"{KEY_BUCKET}=")]
    made = [(f"{buckets}/{n.split('=')[1]}", f"{version}/{n}") for n in written]
    root = version_path(path, "")
    kept = [(label, place.removeprefix(root)) for label, place in stored if label not in labels]
    kept = [part for part in kept if not part[0].endswith("/none")] or (kept if not made else [])
    if not made and not kept:  # columns without rows
        finish(rows).limit(0).write.mode("overwrite").parquet(folder)
        made = [(f"{buckets}/none", version)]
    replace_parts(spark, path, sorted([*kept, *made]), number)
    return sorted(touched)


def append_history(
    spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame], is_open: str
) -> None:
    """Add to a history whose closed rows never change again.

    ``change`` gets the open rows and returns what becomes of them and what is new; rows
    for which ``is_open`` does not hold are closed. Those are added as a part of their own, and the part
    of open rows is written anew.
    """
    number, version = next_pointer(spark, path), new_version()
    stored = current_parts(spark, path) or []
    opened = read_parts(spark, [folder for label, folder in stored if label == "open"])
    rows = stage(change(opened), "history")
    root, parts = version_path(path, ""), []
    closed = rows.filter(~F.expr(is_open))
    if not closed.isEmpty():
        closed.write.mode("errorifexists").parquet(version_path(path, f"{version}/closed"))
        parts.append(("closed", f"{version}/closed"))
    rows.filter(is_open).write.mode("errorifexists").parquet(version_path(path, f"{version}/open"))
    kept = [(label, f.removeprefix(root)) for label, f in stored if label == "closed"]
    replace_parts(spark, path, [*kept, *parts, ("open", f"{version}/open")], number)
