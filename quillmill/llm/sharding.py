"""Sharding by jump consistent hashing, in DataFrame functions only.

Method (Lamping and Veach): a key seeds a 64-bit linear congruential generator, and the key jumps forward over bucket
numbers, each next jump being drawn from the generator, until it would pass the last bucket. No ring table exists, and
with one more shard a key either stays or moves into the new shard. The generator's arithmetic modulo 2^64 is done in
decimals of 38 digits, since ANSI mode forbids long overflow. Both shard counts (n and n + 1) come from one chain.

Cases: a null text has size 1 and the CRC of the empty string. A null key is dealt as key 0. Equal keys always share a
shard; repeated rows get slots of their own. Only the named columns are read. An empty table gives an empty result.
A shard's slots are numbered in two levels (see ``common.numbered``), so no task sees a whole shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered

#: Fixed values of the published algorithm's generator.
MULTIPLIER, INCREMENT, MODULUS = 2862933555777941757, 1, 2**64


def jump_chain(key: str, shards: int) -> Column:
    """STRUCT<shard, grown>: the bucket of the integral column ``key`` among ``shards`` and among ``shards + 1``."""
    dec = "decimal(20,0)"
    seed = f"cast(if({key} < 0, cast({key} as decimal(38,0)) + {MODULUS}BD, cast({key} as decimal(38,0))) as {dec})"
    step = f"cast((cast(s.k as decimal(38,0)) * {MULTIPLIER}BD + {INCREMENT}BD) % {MODULUS}BD as {dec})"
    draw = "cast(floor(t.k / 8589934592BD) as double) + 1"
    return F.expr(f"""
        aggregate(
          sequence(0, {shards}),
          named_struct('k', {seed}, 'j', 0L, 'shard', -1, 'grown', -1),
          (s, i) -> if(s.j > {shards}, s, transform(array(named_struct('k', {step}, 'j', s.j, 'shard', s.shard)), t ->
            named_struct(
              'k', t.k,
              'j', cast(floor((t.j + 1) * (2147483648D / ({draw}))) as bigint),
              'shard', if(t.j < {shards}, cast(t.j as int), t.shard),
              'grown', cast(t.j as int)))[0]),
          s -> named_struct('shard', s.shard, 'grown', s.grown))
    """)


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (with one more shard).

    An ``id_col`` that is not integral is keyed by its ``xxhash64``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    key = F.col(id_col).cast("long") if whole else F.xxhash64(F.col(id_col))
    rows = docs.select(
        F.col(id_col).alias("_qm_id"),
        F.coalesce(key, F.lit(0)).cast("long").alias("_qm_key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("_qm_to", jump_chain("_qm_key", shards))
    rows = rows.select("*", F.col("_qm_to.shard").alias("shard"), F.col("_qm_to.grown").alias("grown_shard"))
    chunk = F.pmod(F.xxhash64("_qm_key"), F.lit(4096))
    rows = numbered(rows, "shard", chunk, [F.col("_qm_key"), F.col("text_crc32"), F.col("size")], "slot")
    return rows.select(F.col("_qm_id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 16)
