"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGED: dict[str, list[str]] = {}


def local_session(cpus: int | str = 8, app: str = "stintlake", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A private temporary folder stands in only for a local master with the
    setting unset; on a cluster an unset folder is an error, because files on
    one machine cannot be read by the others.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="stintlake-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/stintlake/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end, where Spark can (4.1); else these stay
    until the driver happens to collect its garbage. What is written is read from its files."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later stages then restart from files, so a lost executor never recomputes
    what lies before, and every consumer sees the same rows.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(spark: SparkSession) -> int:
    """How many paths this session has taken in the shared folder, for :func:`drop_stages`."""
    return len(_STAGED.get(spark.sparkContext.applicationId, []))


def drop_stages(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete what this session wrote to the shared folder; results must have been read."""
    hadoop = spark._jsc.hadoopConfiguration()
    paths = _STAGED.get(spark.sparkContext.applicationId, [])
    for path in paths[since:until]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)
    del paths[since:until]


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Own what is staged inside: it is deleted at the end, when results must be written."""
    since = staged(spark)
    try:
        yield
    finally:
        drop_stages(spark, since)
