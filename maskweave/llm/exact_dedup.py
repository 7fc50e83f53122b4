"""Exact dedup against a persistent digest index, native DataFrame code.

The index is a table bucketed and sorted by the SHA-256 digest of the text.
New documents are reduced to one row per digest, deduplicated against the
index by a sort-merge anti-join (the index side is not shuffled), and the
new digests are appended.  Texts are compared unchanged; a null text counts
as empty.

Of equal texts in one delivery the row with the largest doc_id stays; a null
doc_id is smaller than any other.  Rows that repeat both doc_id and text
each count in ``group_size`` and are marked alike; ``deduplicate`` keeps one
of them.  Texts that the index already holds keep their earlier keeper.  An
empty table gives no rows; columns other than doc_id and text are carried
along by ``deduplicate`` and ignored elsewhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskweave.llm.common import attach_group
from maskweave.session import materialize, scratch_path


class DigestIndex:
    """A digest index in the folder ``path``, with ``buckets`` buckets
    (``spark.sql.shuffle.partitions`` of the session where none are given;
    an existing index must be opened with the number it was made with)."""

    SCHEMA = "digest binary, keep_id long, keep_rows long, group_size long"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "digest_index_" + uuid.uuid4().hex
        spark.sql(f"create table {self.name} ({self.SCHEMA}) using parquet "
                  f"clustered by (digest) sorted by (digest) into {self.buckets} buckets "
                  f"location '{self.path}'")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> None:
        """Appends the digests that the index does not hold yet."""
        groups = (digests.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
                  .groupBy("digest")
                  .agg(F.max(F.struct("doc_id", "n")).alias("keep"), F.sum("n").alias("group_size"))
                  .select("digest", F.col("keep.doc_id").alias("keep_id"),
                          F.col("keep.n").alias("keep_rows"), "group_size"))
        new = groups.hint("merge").join(self.table().select("digest"), "digest", "left_anti")
        (new.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def drop(self) -> None:
        """Forgets the table; the files stay in ``path``."""
        self.spark.sql(f"drop table if exists {self.name}")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): the only columns that the index needs."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


def classify(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, keep_rows, group_size
    and ``kept``, after adding the documents to the index."""
    index = index or DigestIndex(docs.sparkSession)
    rows = materialize(digests(docs), "digests")
    index.add(rows)
    return (attach_group(rows, index.table(), "digest", "group_size")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns.  Only rows that
    repeat a keeper's doc_id and text are compared once more."""
    index = index or DigestIndex(docs.sparkSession)
    index.add(materialize(digests(docs), "digests"))
    keys = index.table().select(F.col("digest").alias("_mw_digest"), F.col("keep_id").alias("_mw_id"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = (docs.withColumn("_mw_digest", F.unhex(F.sha2(text, 256)))
            .withColumn("_mw_id", F.col("doc_id").cast("long")))
    # both columns are join keys, so that the copies of one text spread over tasks
    same = (rows["_mw_digest"] == keys["_mw_digest"]) & rows["_mw_id"].eqNullSafe(keys["_mw_id"])
    return (rows.join(keys, same, "left_semi").dropDuplicates(["_mw_digest", "_mw_id"])
            .select(*docs.columns))
