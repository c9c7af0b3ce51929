"""Batch readers of the landing zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv
from stintlake.operators.grouping import join_same
from stintlake.sources.schemas import TIME_COLUMNS, entity_schema


def file_pattern(entity: str) -> str:
    """Landing file pattern; an entity without its own uses ``{entity}*.json``."""
    return fv.FILE_PATTERNS.get(entity, f"{entity}*.json")


def table_comment(entity: str) -> str:
    return fv.TABLE_COMMENTS.get(entity, f"Raw {entity} data")


def table_properties(entity: str) -> dict[str, str]:
    props = {"quality": "bronze"}
    if entity in fv.LAYOUT_COLUMNS:
        props["layout.columns"] = ",".join(fv.LAYOUT_COLUMNS[entity])
    return props


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    glob: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Multi-line JSON: a file holds an array of records or one record.

    Without a schema Spark infers the union of the fields of all files. Files with
    one record per line need ``multi_line=False``; they can also be split over tasks.
    """
    reader = spark.read.option("multiLine", multi_line)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(list(path) if not isinstance(path, str) else path)


def with_ingestion(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Add load time and source file, and a batch id if given."""
    out = df.withColumn("_ingestion_timestamp", F.current_timestamp()).withColumn(
        "_source_file", F.col("_metadata.file_path")
    )
    return out if batch_id is None else out.withColumn("_ingestion_batch_id", F.lit(batch_id))


def with_parsed_times(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumns({f"{c}_ts": C.parse_time(c) for c in TIME_COLUMNS.get(entity, ())})


def read_entity(
    spark: SparkSession,
    landing: str | Sequence[str],
    entity: str,
    typed: bool = True,
    batch_id: str | None = None,
    glob: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Landed files of an entity (a folder, or a list of files) with ingestion columns.

    ``typed`` uses the fixed schema and parses the text times; otherwise the
    schema is inferred, and new fields simply appear.
    """
    schema = entity_schema(entity) if typed else None
    files = read_json(spark, landing, schema, glob or file_pattern(entity), multi_line)
    df = with_ingestion(files, batch_id)
    return with_parsed_times(df, entity) if typed else df


def unprocessed_files(
    spark: SparkSession,
    landing: str,
    entity: str,
    log: DataFrame | None,
    glob: str | None = None,
) -> DataFrame:
    """path and _source_file of the landed files that the ``log(_source_file)`` does not name.

    Only names are listed; no file is opened, and the loaded rows are not read.
    """
    names = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob or file_pattern(entity))
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path", F.col("_metadata.file_path").alias("_source_file"))
    )
    if log is None:
        return names
    return join_same(names, log.select("_source_file"), ["_source_file"], "left_anti")
