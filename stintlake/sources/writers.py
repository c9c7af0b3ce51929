"""Table and file sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from stintlake.operators.dedupe import latest_per_key
from stintlake.operators.grouping import join_same


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range-partition and sort by the columns, so files and row groups can be skipped."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    dynamic: bool = False,
) -> str:
    """Write parquet files.

    An overwrite replaces the whole table, or with ``dynamic`` only the partitions
    present in ``df``. Rows of one partition are brought together, and a large
    partition is split over several files (``REBALANCE``). Nothing passes through
    the driver, and no loop over batches is needed.
    """
    if partition_by and cluster_by:
        df = clustered(df, [*partition_by, *cluster_by])
    elif cluster_by:
        df = clustered(df, cluster_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    swap = "dynamic" if dynamic else "static"
    writer = df.write.mode(mode).option("partitionOverwriteMode", swap)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


#: Column with the number of the load that brought a row, where a repeated load replaces its rows.
LOAD = "_load"


def read_table(spark: SparkSession, path: str, evolving: bool = False) -> DataFrame:
    """Read a table; ``evolving`` unites the columns of all its files.

    A table that :func:`replace_table` or :func:`replace_parts` wrote is read at its current state,
    one that is appended to in numbered batches without batches that are not complete. Days and batch ids stay text,
    although Spark takes folder names like ``2024-03-02`` for dates.
    """
    folders = [folder for _, folder in current_parts(spark, path) or [("", path)]]
    batches = complete_batches(spark, folders[0]) if len(folders) == 1 else None
    reader = spark.read.option("mergeSchema", evolving)
    if batches is None:
        df = read_folders(reader, folders)
    else:
        df = reader.option("basePath", folders[0]).parquet(*batches).drop("batch")
    for name in ("batch_day", "_ingestion_batch_id"):
        if name in df.columns:
            df = df.withColumn(name, F.col(name).cast("string"))
    return df.drop(LOAD)


#: How the name of a version begins whose buckets are divided into further folders.
DIVIDED = "_version="


def read_folders(reader: DataFrameReader, folders: Sequence[str]) -> DataFrame:
    """Some parts of a table as one frame."""
    if f"/{DIVIDED}" not in folders[0]:
        return reader.parquet(*folders)
    # Folders below several versions are found from their common root.
    root = folders[0].split(f"/{DIVIDED}")[0]
    rows = reader.option("basePath", root).parquet(*folders)
    return rows.drop(DIVIDED.rstrip("="), KEY_BUCKET)


#: Folders of the buckets of a table.
KEY_BUCKET = "_key_bucket"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    folder, fs = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file with its content; ``False`` if the name is taken already."""
    target, fs = _file_system(spark, path)
    if fs.exists(target):
        return False
    try:
        stream = fs.create(target, False)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    return True


def complete_batches(spark: SparkSession, root: str) -> list[str] | None:
    """Folders of the complete numbered batches; ``None`` for a table without plans of them."""
    names = list_names(spark, root)
    if "_plans" not in names:
        return None
    return [
        f"{root}/{n}" for n in names
        if n.startswith("batch=") and exists(spark, f"{root}/{n}/_SUCCESS")
    ]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table stands there; versions without a pointer are none."""
    if not exists(spark, path):
        return False
    return not exists(spark, f"{path}/{_VERSIONS}") or current_parts(spark, path) is not None


_VERSIONS, _POINTERS = "_versions", "_pointers"


def _pointers(spark: SparkSession, path: str) -> list[str]:
    """Names of the pointers, which are numbers, oldest first."""
    return list_names(spark, f"{path}/{_POINTERS}")


Parts = list[tuple[str, str]]


def _folders(text: str) -> Parts:
    """Label and folder of each part that a pointer names; a table in one part has no label."""
    return [(label, folder) for label, _, folder in (x.rpartition("\t") for x in text.split("\n"))]


def current_parts(spark: SparkSession, path: str) -> Parts | None:
    """Labels and folders of the parts that count, or ``None`` for a table without versions."""
    for name in reversed(_pointers(spark, path)):
        if text := read_text(spark, f"{path}/{_POINTERS}/{name}"):
            return [(label, version_path(path, folder)) for label, folder in _folders(text)]
    return None


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of a table in one part, or ``None`` for a table without versions."""
    parts = current_parts(spark, path)
    if parts and len(parts) > 1:
        raise ValueError(f"{path} is a table of several parts")
    return parts[0][1] if parts else None


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace a table, also by rows derived from itself.

    The new rows are written to a folder of their own; only when they are complete does a new
    pointer, a small file that names the version, make them the table. Nothing is moved, so this
    holds on object stores too, and whoever stops before the pointer leaves the old table as it
    was. The version before stays for readers that are under way; older ones go. Of two writers
    that began from one version, the second is refused.
    """
    spark = df.sparkSession
    seen = next_pointer(spark, path)
    version = new_version()
    write_table(df, f"{path}/{_VERSIONS}/{version}", "errorifexists", partition_by)
    switch_version(spark, path, version, seen)
    return path


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(path: str, version: str) -> str:
    return f"{path}/{_VERSIONS}/{version}"


def next_pointer(spark: SparkSession, path: str) -> int:
    """The number that the next version will have; a writer asks before it reads the table."""
    names = _pointers(spark, path)
    return int(names[-1]) + 1 if names else 0


def switch_version(spark: SparkSession, path: str, version: str, number: int) -> None:
    """Make a complete version the current one, unless another writer took the number."""
    replace_parts(spark, path, [("", version)], number)


def replace_parts(spark: SparkSession, path: str, parts: Parts, number: int) -> None:
    """Make complete folders, named below the versions of the table, the current state.

    Parts that stay are named again; their files are not touched. Folders that neither this
    state nor the one before names are deleted.
    """
    names = _pointers(spark, path)
    later = names and int(names[-1]) >= number
    text = "\n".join(f"{label}\t{folder}" if label else folder for label, folder in parts)
    if later or not claim(spark, f"{path}/{_POINTERS}/{number:012d}", text):
        raise RuntimeError(f"another writer replaced {path} meanwhile")
    kept = {folder for _, folder in parts}
    if names:
        kept |= {folder for _, folder in _folders(read_text(spark, f"{path}/{_POINTERS}/{names[-1]}"))}
    for name in names[:-1]:
        pointer = f"{path}/{_POINTERS}/{name}"
        for _, folder in _folders(read_text(spark, pointer)):
            if folder and folder not in kept:
                remove(spark, version_path(path, folder))
        remove(spark, pointer)
    spark.catalog.refreshByPath(path)


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def append_table(
    df: DataFrame,
    path: str,
    batch_id: str | None = None,
    partition_by: Sequence[str] = (),
    dedupe_keys: Sequence[str] = (),
    order: Sequence[str] = (),
) -> str:
    """Append rows; new columns are kept (read them with ``read_table(evolving=True)``).

    With a ``batch_id`` the rows go to a folder of that name, which a repeat overwrites, so a load
    that stopped, or is run again, gives each row once. Without one, rows loaded twice are there twice.
    ``dedupe_keys`` leaves out rows whose key other batches have and keeps one row per key.
    """
    spark = df.sparkSession
    root = current_version(spark, path) or path
    if dedupe_keys:
        old = read_table(spark, path) if table_exists(spark, path) else None
        if old is not None and batch_id is not None and BATCH in old.columns:
            old = old.filter(~F.col(BATCH).eqNullSafe(batch_id))
        df = append_new(old, df, dedupe_keys, order)
    if batch_id is None:
        return write_table(df, root, "append", partition_by)
    write_table(df, f"{root}/{BATCH}={quote(batch_id, safe='')}", "overwrite", partition_by)
    return root


#: Column, and folder, of the batch that brought a row.
BATCH = "_ingestion_batch_id"


def append_new(
    target: DataFrame | None,
    batch: DataFrame,
    dedupe_keys: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """The rows of the batch to append; see :func:`append_table`.

    Among rows of the batch with one key, the first by ``order`` descending stays.
    """
    if not dedupe_keys:
        return batch
    newest = [F.col(c).desc_nulls_last() for c in order] or [F.col(dedupe_keys[0])]
    ties = [
        f.name for f in batch.schema
        if f.name not in {*dedupe_keys, *order} and f.dataType.typeName() != "map"
    ]
    rows = latest_per_key(batch, dedupe_keys, newest, ties)
    if target is None:
        return rows
    return join_same(rows, target.select(*dedupe_keys), dedupe_keys, "left_anti")


def compact(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> str:
    """Rewrite many small files to ``path`` as files of the advisory partition size.

    ``cluster_by`` names the columns that the table is clustered by: their ranges stay apart.
    Without it rows are dealt to files in any order.
    """
    out = clustered(df, cluster_by) if cluster_by else df.hint("rebalance")
    out.write.mode("errorifexists").parquet(path)
    return path


def export_json(
    df: DataFrame, path: str, stamp: bool = True, compression: str = "none", file_rows: int = 0
) -> str:
    """JSON lines, with an ``ingestion_timestamp`` column unless switched off.

    A compressed file is read by one task; ``file_rows`` bounds its rows (0: no bound).
    """
    out = df.withColumn("ingestion_timestamp", F.current_timestamp()) if stamp else df
    writer = out.write.mode("overwrite").option("compression", compression)
    writer.option("maxRecordsPerFile", file_rows).json(path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with header; arrays become JSON text, which CSV cannot hold otherwise."""
    nested = {"array", "struct", "map"}
    cols = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in nested else F.col(f.name)
        for f in df.schema
    ]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    return path
