"""Exact duplicates through a persistent index of digests, bucketed and sorted by hash.

The index is a Parquet table clustered and sorted by digest. A batch is reduced to one
row per digest before its shuffle, then a sort-merge anti-join takes out what the index
knows, and the rest is appended. A batch that is added twice changes nothing, so a job
that died can simply run again.

Defined cases: a null text counts as empty; equal means equal after lower-casing A-Z;
among equal texts the greatest doc_id stays, a null id only where no other is there; of
rows that repeat both id and text exactly one is kept; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import fresh, read_table, shared_folder, staged

BUCKETS = 32  # files of the index per append; raise it with the number of distinct texts


def digest(text: str | Column) -> Column:
    """SHA-256, as 32 bytes, of a text with A-Z in lower case."""
    text = F.col(text) if isinstance(text, str) else text
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(folded, 256))


class DigestIndex:
    """Known digests and the id that stays for each, in a folder that outlives the session."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.table = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, folder).hex
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'")

    @classmethod
    def new(cls, spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
        return cls(spark, f"{shared_folder(spark)}/digests", buckets)

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks."""
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add (digest, keep_id) rows that the index lacks."""
        # Dealt out by the number of the bucket, so that each bucket is written by one task.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        new = self.unseen(groups).select("digest", "keep_id").withColumn("bucket", bucket)
        new.repartition(self.buckets, "bucket").drop("bucket").write.insertInto(self.table)


def one_per_digest(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))


def index_newest_first(digests: DataFrame, index: DigestIndex) -> None:
    """Add a table in two batches, the upper half of the ids first: whatever a later batch
    finds in the index has a greater id, so the greatest id of equal texts stays."""
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = F.lit(0 if low is None else (low + high) // 2)
    upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    for batch in (upper, ~upper):
        index.append(one_per_digest(digests.where(batch)))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    With an index from earlier batches, texts it knows keep the id of the earlier batch.
    """
    spark = docs.sparkSession
    index = index or DigestIndex.new(spark)
    digests = staged(docs.select("doc_id", digest("text").alias("digest")), "digests")
    index_newest_first(digests, index)
    # One row per digest on the one side; on the other, rows of a frequent text form a
    # partition that adaptive execution splits.
    sizes = digests.groupBy("digest").agg(F.count("*").alias("group_size"))
    known = index.read().join(sizes, "digest")
    copies = digests.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))
    rows = copies.join(known, "digest").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``docs`` without exact copies, all columns kept.

    Of rows equal in text and id, the least by the other columns stays.
    """
    spark = docs.sparkSession
    columns = docs.columns
    d, k = fresh(docs, "digest", "keep_id")
    index = index or DigestIndex.new(spark)
    digests = staged(docs.select("doc_id", digest("text").alias("digest")), "digests")
    index_newest_first(digests, index)
    known = index.read().select(F.col("digest").alias(d), F.col("keep_id").alias(k))
    # The id is part of the join key, so copies of one text spread over all partitions.
    marked = docs.withColumn(d, digest("text"))
    stay = marked.join(known, (marked[d] == known[d]) & marked["doc_id"].eqNullSafe(known[k])).select(
        marked[d], *[marked[c] for c in columns])
    order = ["doc_id", *[c for c in columns if c not in ("doc_id", "text")], "text"]
    least = stay.groupBy(d, "doc_id").agg(F.min(F.struct(*order)).alias(k))
    return least.select(*[F.col(k)[c].alias(c) for c in columns])


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(read_table(spark, folder, "documents"))


SQL = f"""
WITH folded AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM folded WINDOW same AS (PARTITION BY text_sha256)
"""
