"""Loads that may stop anywhere and be repeated: what a load takes is fixed before it begins.

A load is numbered, and its plan names the source files that it takes: all that no earlier plan
names, whenever they came. So files that a slow writer commits late are taken by the next load,
although their load time is older than that of rows already there. A load that did not end is
repeated with its own plan before another begins.

An appending load writes to a folder of its own, which a repeat overwrites; the folder counts once
it is complete, so rows and plan are one commit. A merging load says when it has ended; repeating
it changes nothing, as the merge of the same rows gives the same table.

Source files must stay as they are: rewriting them (compaction, say) calls for a full refresh.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from stintlake.sources.writers import (
    claim,
    current_version,
    exists,
    list_names,
    read_table,
    read_text,
    write_table,
)

_PLANS = "_plans"
_DONE = ".done"


def _plans(spark: SparkSession, log: str) -> dict[int, list[str]]:
    """Source files by load; a plan that was never written out is left out."""
    names = [n for n in list_names(spark, f"{log}/{_PLANS}") if not n.endswith(_DONE)]
    texts = {int(n): read_text(spark, f"{log}/{_PLANS}/{n}") for n in names}
    return {n: text.split("\n") for n, text in texts.items() if text}


def next_load(
    spark: SparkSession, source: DataFrame, log: str, ended: Callable[[int], bool]
) -> tuple[int, list[str]] | None:
    """Number and source files of the load to run now, or ``None`` if nothing is new.

    File names only come to the driver, where Spark's own listing of the source has them anyway. Two
    loads that begin at once ask for one number; the second is refused.
    """
    plans = _plans(spark, log)
    for number in sorted(plans):
        if not ended(number):
            return number, plans[number]
    taken = {name for names in plans.values() for name in names}
    files = sorted(set(source.inputFiles()) - taken)
    if not files:
        return None
    used = [int(n.removesuffix(_DONE)) for n in list_names(spark, f"{log}/{_PLANS}")]
    number = max(used, default=-1) + 1
    if not claim(spark, f"{log}/{_PLANS}/{number:012d}", "\n".join(files)):
        raise RuntimeError(f"another load of {log} began meanwhile")
    return number, files


def _rows_of(spark: SparkSession, source: DataFrame, root: str, files: Sequence[str]) -> DataFrame:
    """The rows of some files of a table, with the columns of the whole."""
    folders = [f.name for f in source.schema]
    rows = spark.read.schema(source.schema).option("basePath", root).parquet(*files)
    return rows.select(*folders)


def append_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    build: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> int:
    """Append what ``build`` makes of the source files not taken yet; returns the loads that ran.

    ``target`` is a table that only this function writes, or its current version.
    """
    root = current_version(spark, target) or target
    rows = read_table(spark, source, evolving=True)
    loads = 0
    while load := next_load(
        spark, rows, root, lambda n: exists(spark, f"{root}/batch={n}/_SUCCESS")
    ):
        number, files = load
        new = _rows_of(spark, rows, current_version(spark, source) or source, files)
        write_table(build(new), f"{root}/batch={number}", "overwrite", partition_by)
        loads += 1
    return loads


def any_ended(spark: SparkSession, log: str) -> bool:
    """Whether a merging load of this log has ended."""
    return any(n.endswith(_DONE) for n in list_names(spark, f"{log}/{_PLANS}"))


def merge_new_files(
    spark: SparkSession, source: str, log: str, merge: Callable[[DataFrame, int], None]
) -> int:
    """Hand the rows of source files not taken yet to ``merge``, which may be repeated.

    It also gets the number of the load, which is the same when the load is repeated.
    """
    rows = read_table(spark, source, evolving=True)
    loads = 0
    while load := next_load(spark, rows, log, lambda n: exists(spark, f"{log}/{_PLANS}/{n:012d}{_DONE}")):
        number, files = load
        merge(_rows_of(spark, rows, current_version(spark, source) or source, files), number)
        claim(spark, f"{log}/{_PLANS}/{number:012d}{_DONE}", "done")
        loads += 1
    return loads
