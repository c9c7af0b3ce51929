"""Build and refresh all layers as tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators.incremental import merge_upsert
from stintlake.plans import silver
from stintlake.plans.gold_changes import refresh_gold
from stintlake.plans.snapshots import driver_snapshot, session_snapshot
from stintlake.plans.warehouse import BRONZE, Warehouse
from stintlake.session import stage, staging
from stintlake.sources.batches import append_new_files, merge_new_files
from stintlake.sources.parts import append_history, change_buckets
from stintlake.sources.readers import read_entity, unprocessed_files
from stintlake.sources.writers import (
    new_version,
    next_pointer,
    read_table,
    remove,
    switch_version,
    table_exists,
    version_path,
    write_table,
)
from stintlake.streaming.expectations import LAPS_DROP, LAPS_TRACK, LOCATIONS_DROP
from stintlake.streaming.ingest import append_stream, chain_stream, checked_stream, stream_entity

def _current(spark: SparkSession, target: str) -> DataFrame | None:
    return read_table(spark, target) if table_exists(spark, target) else None


def _days(entity: str) -> list[str]:
    return ["batch_day"] if entity in ("laps", "locations") else []


def _log_path(path: str, entity: str) -> str:
    return f"{path}/_files/bronze_{entity}"


def load_bronze(spark: SparkSession, landing: str, path: str, entity: str) -> None:
    """Append the landed files that are new since the last call, each exactly once.

    A triggered stream: its checkpoint remembers the files, and batches of bounded
    size keep a first load of very many files as safe as a small one. A table has one way of
    loading: one that :func:`load_new_files` began is refused.
    """
    if table_exists(spark, _log_path(path, entity)):
        raise ValueError(f"bronze_{entity} is loaded in batches; a stream would hide their rows")
    append_stream(
        stream_entity(spark, landing, entity),
        f"{path}/bronze_{entity}",
        f"{path}/_checkpoints/bronze_{entity}",
        partition_by=_days(entity),
    ).awaitTermination()


def load_new_files(
    spark: SparkSession, landing: str, path: str, entity: str, max_files: int = 1000,
    glob: str | None = None, multi_line: bool = True,
) -> int:
    """The same without a stream, by a log of the files that were loaded; returns how many.

    The landed files are listed once and taken ``max_files`` at a time. A batch is a folder of
    the table that a repeated load overwrites, and its files are logged when the folder is
    complete, so a stop at any point neither loses nor doubles rows. A file without rows is
    logged like any other. A table that a stream loads is refused.
    """
    target, log = f"{path}/bronze_{entity}", _log_path(path, entity)
    if table_exists(spark, f"{target}/_spark_metadata"):
        raise ValueError(f"bronze_{entity} is loaded by a stream, which would hide other rows")
    done = _current(spark, log)
    batch = (done.agg(F.max("batch")).first()[0] or 0) + 1 if done is not None else 1
    with staging(spark):
        listed = stage(unprocessed_files(spark, landing, entity, done, glob), "landed")
        last, loaded = "", 0
        # At most max_files names are on the driver at a time.
        while files := listed.filter(F.col("path") > last).orderBy("path").limit(max_files).collect():
            names = [r.path for r in files]
            rows = read_entity(
                spark, names, entity, batch_id=str(batch), glob="*", multi_line=multi_line
            )
            write_table(rows, f"{target}/load={batch}", "overwrite", _days(entity))
            taken = listed.filter(F.col("path").between(names[0], names[-1]))
            write_table(taken.select("_source_file"), f"{log}/batch={batch}")
            last, loaded, batch = names[-1], loaded + len(names), batch + 1
    return loaded


def load_quality(spark: SparkSession, path: str) -> None:
    """Bring the laps and locations quality tables up to their bronze tables.

    Each is a stream over the bronze table. Per batch, the rows that meet the expectations and
    the counts of those that do not go to folders that a repeated batch overwrites.
    """
    for entity, (drop, track) in {
        "laps": (LAPS_DROP, LAPS_TRACK), "locations": (LOCATIONS_DROP, {}),
    }.items():
        if table_exists(spark, f"{path}/bronze_{entity}"):
            checked_stream(
                chain_stream(spark, f"{path}/bronze_{entity}"), f"{path}/quality_{entity}",
                f"{path}/quality_{entity}_counts", f"{path}/_checkpoints/quality_{entity}",
                drop, track,
            ).awaitTermination()


def refresh_snapshots(spark: SparkSession, path: str, run_ts: str) -> None:
    """Take the next snapshot of drivers and sessions from the silver tables.

    Only open versions are read and written again; those that close are added once.
    """
    for name, build, source in (
        ("driver_snapshot", driver_snapshot, "silver_drivers"),
        ("session_snapshot", session_snapshot, "silver_sessions"),
    ):
        rows = read_table(spark, f"{path}/{source}")
        with staging(spark):
            append_history(
                spark, f"{path}/{name}", lambda opened: build(opened, rows, run_ts), "valid_to IS NULL"
            )


def refresh_silver(spark: SparkSession, path: str, run_ts: str, full: bool = False) -> None:
    """Bring the silver tables up to the bronze ones.

    Sessions and drivers are merged, laps and locations appended, from the bronze files that no
    earlier load took; a load that stopped is repeated first (see
    :mod:`stintlake.sources.batches`). ``full`` rebuilds them all.
    """
    for entity, build, key, updates in (
        ("sessions", silver.build_silver_sessions, silver.SESSION_KEY, silver.SESSION_UPDATES),
        ("drivers", silver.build_silver_drivers, silver.DRIVER_KEY, silver.DRIVER_UPDATES),
    ):
        target, source = f"{path}/silver_{entity}", f"{path}/bronze_{entity}"

        log = f"{path}/_loads/silver_{entity}"
        anew = full or not table_exists(spark, target)
        if anew:  # one load of all files, which replaces the table when it is complete
            remove(spark, log)

        def merge(new: DataFrame, number: int) -> None:
            change_buckets(
                target, build(new, run_ts), key,
                lambda old, batch: merge_upsert(old, batch, key, updates), fresh=anew,
            )

        merge_new_files(spark, source, log, merge)

    for entity, build in (
        ("laps", silver.build_silver_laps),
        ("locations", silver.build_silver_locations),
    ):
        target, source = f"{path}/silver_{entity}", f"{path}/bronze_{entity}"
        if not full:
            append_new_files(spark, source, target, lambda new: build(new, run_ts), ["batch_day"])
            continue
        number, version = next_pointer(spark, target), new_version()
        append_new_files(
            spark, source, version_path(target, version), lambda new: build(new, run_ts), ["batch_day"]
        )
        switch_version(spark, target, version, number)


def build_all(sources: Warehouse, spark: SparkSession, path: str, run_ts: str) -> Warehouse:
    """Full refresh of every table from bronze sources into ``path``."""
    for name in BRONZE:
        write_table(sources.table(name), f"{path}/{name}")
    refresh_silver(spark, path, run_ts, full=True)
    refresh_gold(spark, path, run_ts, full=True)
    return Warehouse.at_path(spark, path)
