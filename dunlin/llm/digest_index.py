"""Exact dedup against a persistent index of digests, bucketed and sorted by digest.

The index is a bucketed table on shared storage with one row per digest and batch it came in.
A batch is hashed, reduced to one row per digest (map-side first, so a text with very many
copies is one row per task), sort-merge anti-joined with the index, and appended: new digests
with the id that stays, known ones with their count only. The index side of each join is read
bucket by bucket and never shuffled. Rows carry the id of their batch, so a batch that is run
again after a crash sees the index as it was before and leaves it as it would have been.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dunlin.llm.common import drop_stage, new_folder, path_exists, stage, text_or_empty

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    """The text with each run of ASCII white space as one space; NULL is empty."""
    return F.regexp_replace(text_or_empty(text), WHITE_SPACE, " ")


def digest_of(text: str = "text") -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far, below ``path`` (a new folder of the shared storage by default).

    Opening an existing ``path`` continues its index; the number of buckets is stored with it
    and another one is refused. Each row: ``digest``, ``batch``, ``n`` (rows of the batch),
    ``is_first`` (the digest was new in this batch) and then ``keep_id``, the id that stays.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or new_folder(spark, "digests")
        about = f"{self.path}/about"
        if path_exists(spark, about):
            stored = spark.read.schema("buckets int").parquet(about).first().buckets
            if buckets not in (None, stored):
                raise ValueError(f"the index has {stored} buckets, not {buckets}")
            self.buckets = stored
        else:
            self.buckets = buckets or 64
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(about)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, batch STRING, n BIGINT, is_first BOOLEAN, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE {self.name}")

    def seen(self, groups: DataFrame, batch: str) -> DataFrame:
        """``groups`` (one row per digest) with ``seen``, the rows of other batches, and
        ``kept_id``, the id that stays; both NULL for a new digest."""
        before = self.table().where(F.col("batch") != batch).groupBy("digest").agg(
            F.sum("n").alias("seen"), F.max(F.when(F.col("is_first"), F.col("keep_id"))).alias("kept_id"))
        return groups.join(before.hint("merge"), "digest", "left")

    def add(self, groups: DataFrame, batch: str) -> None:
        """Append a batch, ``groups`` of (digest, keep_id, n) with one row per digest. Rows that
        an earlier run of the batch has appended already are left as they are."""
        earlier = self.table().where(F.col("batch") != batch).select("digest")
        own = self.table().where(F.col("batch") == batch).select("digest")
        rest = groups.join(own.hint("merge"), "digest", "left_anti")
        new = groups.join(earlier.hint("merge"), "digest", "left_anti").select("digest", F.lit(True).alias("is_first"))
        rows = rest.join(new.hint("merge"), "digest", "left").select(
            "digest", F.lit(batch).alias("batch"), "n", F.coalesce("is_first", F.lit(False)).alias("is_first"),
            F.when(F.col("is_first"), F.col("keep_id")).alias("keep_id"))
        fresh = stage(rows, "new-digests")
        (
            fresh.repartition(self.buckets, "digest").write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").option("path", f"{self.path}/rows")
            .saveAsTable(self.name)
        )
        drop_stage(fresh)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size (rows of equal
    text seen so far), kept, text_sha256, and ``row``, the number of the row.

    NULL and empty texts are equal to each other. Of rows that repeat both text and doc_id
    exactly one is kept; rows without a doc_id are kept only if no row of their text has one,
    and then one of them. An id that came in an earlier batch stays over any later one. A batch
    that is run again under its name ``batch`` gives the same result and counts once. An empty
    table gives no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    own_index = index is None
    index = index or DigestIndex(spark)
    batch = batch or uuid.uuid4().hex
    rows = stage(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest_of("text").alias("digest"))
        .withColumn("row", F.monotonically_increasing_id()), "row-digests",
    )
    groups = rows.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("here"))
    groups = stage(index.seen(groups, batch), "batch-groups")
    index.add(groups.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("here").alias("n")), batch)
    if own_index:
        index.close()
    is_new = F.col("seen").isNull()
    return (
        rows.join(groups.hint("merge"), "digest")
        .select(
            "doc_id", F.when(is_new, F.col("first.doc_id")).otherwise(F.col("kept_id")).alias("keep_id"),
            (F.col("here") + F.coalesce("seen", F.lit(0))).alias("group_size"),
            (is_new & (F.col("row") == F.col("first.row"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), "row",
        )
    )
