"""What the training-data operators share: scratch tables, two-level numbering, hot-key-safe attachment."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: ASCII white space, as Java and RE2 regular expressions both read it.
SPACE = r"[\x20\x09-\x0D]"

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a single-process session (master ``local``) gets a temporary folder; on a cluster executors would
    each write to a disk of their own, so there it is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is not set: on {master} intermediate tables need a folder that driver and executors share")
        at = _OWN_DIR.setdefault(spark.sparkContext.applicationId, "file:" + tempfile.mkdtemp(prefix="quillmill-"))
    return at.rstrip("/")


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/quillmill-{tag}-{uuid.uuid4().hex}"


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends here and survives lost executors.

    What is not dropped before is deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    for p in (path, *(own for own in _OWN_DIR.values() if path.startswith(own))):
        fs, where = _located(spark, p)
        fs.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._qm_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Deletes what ``saved`` wrote for these frames, once nothing reads them any more."""
    for df in frames:
        fs, where = _located(df.sparkSession, df._qm_path)
        fs.delete(where, True)


def numbered(df: DataFrame, group: str, chunk: Column, order: list[Column], name: str, amount: Column | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` (default: 1 a row) over the rows of ``group`` that come before, from 0.

    Rows are ordered by ``chunk`` and then ``order``. No task sees a whole group: the running sum is kept inside
    (group, chunk), and the chunks' own totals, one row each, give the offsets. So a group with a third of all rows
    is spread over as many tasks as it has chunks. Without ``amount`` the numbers are gapless. The chunks, one row each,
    are summed up in one task a group, so their number must be bounded.
    """
    amount = F.lit(1).cast("long") if amount is None else amount
    rows = df.withColumn("_qm_chunk", chunk).withColumn("_qm_amount", amount)
    inner = W.partitionBy(group, "_qm_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    outer = W.partitionBy(F.col("_qm_g")).orderBy("_qm_c").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(F.col(group).alias("_qm_g"), F.col("_qm_chunk").alias("_qm_c"))
        .agg(F.sum("_qm_amount").alias("_qm_total"))
        .select("_qm_g", "_qm_c", F.coalesce(F.sum("_qm_total").over(outer), F.lit(0)).alias("_qm_before"))
    )
    running = rows.withColumn("_qm_run", F.sum("_qm_amount").over(inner) - F.col("_qm_amount"))
    same = F.col(group).eqNullSafe(F.col("_qm_g")) & (F.col("_qm_chunk") == F.col("_qm_c"))
    return running.join(offsets, same).withColumn(name, F.col("_qm_before") + F.col("_qm_run")).drop(
        "_qm_chunk", "_qm_amount", "_qm_run", "_qm_g", "_qm_c", "_qm_total", "_qm_before"
    )


def in_ranges(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """``df``, written in ranges of ``order``, with the number of each row's range in ``_qm_range``: a chunk for ``numbered``."""
    return saved(df.repartitionByRange(*order).withColumn("_qm_range", F.spark_partition_id()), tag)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, most_hot: int = 4096) -> DataFrame:
    """Left join of ``rows`` to ``groups`` (unique by ``key``; ``size``: rows of the key) that no hot key can unbalance.

    A group of at least ``total / most_hot`` rows is hot. The sizes add up to ``total``, so at most ``most_hot``
    groups are: those, and only those, are broadcast. The other rows meet their group by an ordinary shuffle.
    """
    least = max(64, -(-total // most_hot))
    hot = groups.filter(F.col(size) >= least).withColumn("_qm_hot", F.lit(True))
    cold = groups.filter(F.col(size) < least)
    seen = rows.join(F.broadcast(hot.select(key, "_qm_hot")), key, "left")
    rest = seen.filter(F.col("_qm_hot").isNull()).drop("_qm_hot").join(cold, key, "left")
    return rows.join(F.broadcast(hot.drop("_qm_hot")), key).select(rest.columns).unionByName(rest)


def staying(docs: DataFrame, decided: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """The rows of ``docs`` that stay; ``decided`` (id, digest, kept) has a row per row, and rows without an id stay.

    Ids none of whose rows stay are anti-joined alone: they are few and narrow, so Spark may broadcast them. The text's
    digest only decides for ids that have rows of both kinds, as an id that occurs with several texts.
    """
    fates = decided.filter("id is not null").groupBy("id").agg(F.bool_and("kept").alias("all"), F.bool_or("kept").alias("some"))
    fates = saved(fates.filter("not all").select(F.col("id").alias("_qm_gone"), "some"), "gone")
    out = docs.join(fates.filter("not some").select("_qm_gone"), F.col(id_col) == F.col("_qm_gone"), "left_anti")
    both = fates.filter("some").select("_qm_gone")
    if both.isEmpty():
        return out
    pairs = decided.filter("not kept").join(both, F.col("id") == F.col("_qm_gone")).select("_qm_gone", F.col("digest").alias("_qm_digest"))
    pairs = saved(pairs.distinct(), "gone-texts")
    return out.join(pairs, (F.col(id_col) == F.col("_qm_gone")) & (digest == F.col("_qm_digest")), "left_anti")
