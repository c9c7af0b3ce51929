"""Exact duplicates by a persistent digest index, bucketed and sorted by the digest.

New rows are reduced to one row per digest (partial aggregation, so a text with a third of all
rows costs one row per task), meet the index in a sort-merge anti-join that moves and sorts no
index row, and the digests not found are appended. DataFrame operations only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.llm.common import ascii_lower, stage

#: Buckets of the index; a property of the stored table, so chosen once for its final size.
BUCKETS = 64


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and digest (sha256 of the text with A-Z lower-cased; NULL as empty text)."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


class DigestIndex:
    """The stored digests: a table ``name`` with columns digest, keep_id and batch.

    With ``path`` the files outlive the session: opening the index again with the same name,
    path and ``buckets`` continues it.
    """

    def __init__(
        self, spark: SparkSession, name: str, *, path: str | None = None, buckets: int = BUCKETS
    ):
        self.spark, self.name, self.buckets = spark, name, buckets
        place = f"LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, batch STRING)"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS {place}"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget an index that was made for one batch; results do not read it."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append_new(self, groups: DataFrame, batch: str) -> None:
        """Append the digests of ``groups(digest, keep_id)`` that the index does not hold."""
        stored = self.read().select("digest").hint("merge")
        new = groups.select("digest", "keep_id").join(stored, "digest", "left_anti")
        (
            stage(new, "new-digests")  # an append may not read the table that it changes
            .select("digest", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.mode("append").format("parquet")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)

    def deduplicate(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Add ``docs(doc_id, text)`` to the index and say for each row whether it stays.

        Returns one row per row of ``docs``: doc_id, digest, keep_id (the row that stays),
        group_size (rows of this batch with the text), kept, and repeated (rows with the id and
        the text of the one that stays were there several times). Of equal texts in a batch the
        largest doc_id stays; texts known from earlier batches keep their stored row, and all
        rows of the new batch are dropped.

        - NULL text equals empty text. A NULL doc_id never stays beside other ids; a text that
          has only NULL ids keeps one of them, by NULL keep_id and one ``kept`` row.
        - Rows repeated with the same doc_id and text: one of them is kept.
        - An empty table gives no rows and leaves the index alone.
        - Other columns of ``docs`` are ignored.
        """
        batch = batch or uuid.uuid4().hex
        rows = stage(digests(docs), "digests")
        per_id = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))
        groups = stage(
            per_id.groupBy("digest").agg(
                F.max("doc_id").alias("keep_id"),
                F.sum("copies").alias("group_size"),
                F.max(F.struct("doc_id", "copies"))["copies"].alias("copies"),
            ),
            "digest-groups",
        )
        self.append_new(groups, batch)
        stored = self.read().select(
            "digest", F.col("keep_id").alias("stored_id"),
            (F.col("batch") == batch).alias("is_new"),
        )
        resolved = stage(
            groups.hint("merge").join(stored, "digest").select(
                "digest", F.col("stored_id").alias("keep_id"), "group_size", "copies", "is_new"
            ),
            "resolved",
        )
        out = rows.join(resolved, "digest").select(
            "doc_id", "digest", "keep_id", "group_size", "copies",
            (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        )
        return _one_of_repeated(out)


def _one_of_repeated(out: DataFrame) -> DataFrame:
    """Among rows repeated with the id that stays, keep the first by place only."""
    place = F.struct(F.spark_partition_id(), F.monotonically_increasing_id())
    out = out.withColumn("repeated", F.col("kept") & (F.col("copies") > 1)).drop("copies")
    alone = out.filter("not repeated")
    repeated = stage(out.filter("repeated").withColumn("_place", place), "repeated")
    first = repeated.groupBy("digest").agg(F.min("_place").alias("_first"))
    marked = repeated.join(first, "digest").withColumn("kept", F.col("_place") == F.col("_first"))
    return alone.unionByName(marked.drop("_place", "_first"))


def keep_unique(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names."""
    decided = stage(
        index.deduplicate(docs).filter("kept").select("doc_id", "digest", "repeated"), "kept"
    ).select(F.struct("*").alias("one"))
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.select(
        F.struct("*").alias("row"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    )
    same = (F.col("digest") == F.col("one.digest")) & F.col("row.doc_id").eqNullSafe(F.col("one.doc_id"))
    rows = keyed.join(decided.hint("shuffle_hash"), same)  # texts are streamed, not sorted
    if decided.filter("one.repeated").isEmpty():
        return rows.select("row.*")
    once = rows.filter("one.repeated").dropDuplicates(["digest"])
    return rows.filter("not one.repeated").unionByName(once).select("row.*")
