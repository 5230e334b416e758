"""Exact de-duplication against a persistent digest index, bucketed and sorted by hash.

Method: every text is normalised (each run of ASCII white space becomes one space) and hashed with SHA-256. The index
is a table with one row per distinct digest, ``CLUSTERED BY (digest) SORTED BY (digest)``. A batch is reduced to one
row per digest before anything is joined, then sort-merge anti-joined with the index, and what remains is appended, one
file a bucket. Only digests travel; texts are read once. An index that a query makes for itself is dropped by it.

Cases: a null text counts as empty, so all null and empty texts are one group. Texts of any length are hashed whole.
Of equal texts the smallest id stays; rows that repeat that very id stay with it. A null id never wins against a
number, and a group with only null ids keeps all its rows under a null ``keep_id``. An empty table gives an empty
result and appends nothing. Only the named id and text columns are read, so other columns can have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, attach, drop, saved, staying


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """A catalogue table (digest binary, keep_id long), in ``buckets`` buckets sorted by digest.

    ``path`` makes it an external table there, so that another session can open it again; without it the table lies
    in the warehouse. ``buckets`` defaults to the session's shuffle partitions. The index is never shuffled: the batch's
    groups are dealt once more, by digest, to meet it bucket by bucket.
    """

    def __init__(self, spark: SparkSession, table: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.table, self.path = spark, table, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.tableExists(table):
            at = f"LOCATION '{path}'" if path else ""
            spark.sql(
                f"CREATE TABLE {table} (digest BINARY, keep_id BIGINT) USING parquet {at}"
                f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
            )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """``groups`` (digest, keep_id), unique by digest: those whose digest is new are appended."""
        new = groups.select("digest", "keep_id").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new = saved(new, "index-batch")
        # dealt as the buckets are, so that a bucket is written by one task, as one file
        writer = new.repartition(self.buckets, "digest").write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.table)
        drop(new)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def resolve(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size (rows of this batch with the text), kept, text_sha256.

    ``keep_id`` is the id that the index holds for the text after the batch was appended: that of an earlier batch if
    one had the text, else the batch's smallest. ``kept`` marks the rows that stay.
    """
    rows = docs.select(F.col(id_col).alias("_qm_id"), _digest(F.col(text_col)).alias("digest"))
    rows = saved(rows, "digests")
    groups = rows.groupBy("digest").agg(F.min("_qm_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = saved(groups, "digest-groups")
    index.append(groups)
    known = saved(groups.select("digest", "group_size").join(index.rows().hint("merge"), "digest"), "digest-known")
    drop(groups)
    return (
        attach(rows, known, "digest", "group_size", rows.count())
        .select(
            F.col("_qm_id").alias(id_col),
            "keep_id",
            "group_size",
            F.col("_qm_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def fresh_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, f"quillmill_digests_{uuid.uuid4().hex}")


def resolved_afresh(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``resolve`` against an index of its own, which does not outlive the call."""
    index = fresh_index(docs.sparkSession)
    try:
        return resolve(docs, index, id_col, text_col)
    finally:
        index.drop()


def dedup_exact(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; rows without an id stay. Rows go by id and text."""
    out = resolve(docs, index, id_col, text_col) if index else resolved_afresh(docs, id_col, text_col)
    decided = out.select(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("digest"), "kept")
    return staying(docs, decided, id_col, _digest(F.col(text_col)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved_afresh(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
"""
