"""Streaming ingestion of the landing zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stintlake.sources.readers import file_pattern, read_json, with_ingestion, with_parsed_times
from stintlake.sources.schemas import DDL, entity_schema
from stintlake.streaming.expectations import expect_drop, expectation_counts

FILES_PER_TRIGGER = 1000
FILE_COLUMNS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# Fixed value: location files are large, so a batch takes this many.
LOCATION_FILES_PER_TRIGGER = 10


def max_files(entity: str) -> int:
    return LOCATION_FILES_PER_TRIGGER if entity == "locations" else FILES_PER_TRIGGER


def stream_entity(
    spark: SparkSession,
    landing: str,
    entity: str,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """New files of an entity as a stream with the fixed schema."""
    reader = (
        spark.readStream.schema(entity_schema(entity))
        .option("multiLine", multi_line)
        .option("pathGlobFilter", glob or file_pattern(entity))
        .option("maxFilesPerTrigger", max_files_per_trigger or max_files(entity))
    )
    return with_parsed_times(with_ingestion(reader.json(landing)), entity)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to parquet files, each row exactly once.

    Without ``every`` the query reads what is there and ends; otherwise it goes on
    at that interval.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def chain_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream over a table that another stream appends to."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def checked_stream(
    df: DataFrame,
    path: str,
    counts: str,
    checkpoint: str,
    drop: dict[str, str],
    track: dict[str, str],
    every: str | None = None,
) -> StreamingQuery:
    """Append the rows that meet the ``drop`` expectations, and count all violations per batch.

    ``counts`` gets expectation, passed_records and failed_records of each batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # spills to disk; read for the rows and for the counts
        good = batch
        for name, predicate in drop.items():
            good = expect_drop(good, name, predicate)
        good.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        expectation_counts(batch, {**drop, **track}).write.mode("overwrite").parquet(
            f"{counts}/batch={batch_id}"
        )
        batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def evolving_batch(entity: str, target: str, multi_line: bool = True):
    """A ``foreachBatch`` function that infers each batch and keeps new columns.

    Known columns get their fixed type, others are kept as text, so files of
    different loads never disagree on a type. A value that does not fit its type becomes NULL,
    and its text is kept in ``_rescued``, a JSON object by column name. A batch has its own
    folder, which a retry overwrites: rows are neither lost nor doubled.
    """
    known = {f.name: f.dataType for f in entity_schema(entity)} if entity in DDL else {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # File names only, at most maxFilesPerTrigger of them.
        paths = [r.path for r in batch.select("path").collect()]
        if not paths:
            return
        raw = with_ingestion(read_json(spark, paths, multi_line=multi_line))
        cols, rescued = [], []
        for f in raw.schema:
            nested = f.dataType.typeName() in ("struct", "array", "map")
            text = F.to_json(f.name) if nested else F.col(f.name).cast("string")
            if f.name in known:
                # Spark has no cast from a nested type to a plain one, not even one that may fail.
                same = nested == (known[f.name].typeName() in ("struct", "array", "map"))
                value = (F.col(f.name) if same else F.lit(None)).try_cast(known[f.name])
                cols.append(value.alias(f.name))
                bad = value.isNull() & F.col(f.name).isNotNull()
                rescued += [F.lit(f.name), F.when(bad, text)]
            elif f.name.startswith("_"):
                cols.append(F.col(f.name))
            else:
                cols.append(text.alias(f.name))
        if rescued:
            kept = F.map_filter(F.create_map(*rescued), lambda _, v: v.isNotNull())
            cols.append(F.when(F.size(kept) > 0, F.to_json(kept)).alias("_rescued"))
        raw.select(*cols).write.mode("overwrite").parquet(
            f"{target}/_ingestion_batch_id={batch_id}"
        )

    return write


def evolving_stream(
    spark: SparkSession,
    landing: str,
    entity: str,
    target: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
    glob: str | None = None,
    multi_line: bool = True,
) -> StreamingQuery:
    """Stream files without a fixed schema.

    A JSON stream needs a schema before it starts, so the stream is one of file
    names and each batch reads its files with inference. Read the result with
    :func:`stintlake.sources.writers.read_table`.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("pathGlobFilter", glob or file_pattern(entity))
        .option("maxFilesPerTrigger", max_files_per_trigger or max_files(entity))
        .load(landing)
        .select("path")
    )
    writer = names.writeStream.foreachBatch(evolving_batch(entity, target, multi_line)).option(
        "checkpointLocation", checkpoint
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
