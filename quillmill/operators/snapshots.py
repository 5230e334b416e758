"""Snapshot series: append-only rows stamped snapshot_at; times are compared as times, never as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def stamped(topics: DataFrame, dataset: str, rule_version: str, lexicon_version: str, lexicon_hash: str, at: Column | None = None) -> DataFrame:
    return topics.withColumns(
        {
            "dataset_id": F.lit(dataset), "rule_version": F.lit(rule_version), "release_lexicon_version": F.lit(lexicon_version),
            "lexicon_content_hash": F.lit(lexicon_hash), "snapshot_at": at if at is not None else F.current_timestamp(),
        }
    )


def of_release(rows: DataFrame, version: str | None = None, content_hash: str | None = None) -> DataFrame:
    """Each condition holds only if a value is given and the column is there."""
    for name, value in (("release_lexicon_version", version), ("lexicon_content_hash", content_hash)):
        if value and name in rows.columns:
            rows = rows.filter(F.col(name) == value)
    return rows


def latest(rows: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """The rows of each key's latest snapshot: a maximum per key, joined back; no window gathers a series."""
    newest = rows.groupBy(*keys).agg(F.max("snapshot_at").alias("_qm_last"))
    same = [rows[k].eqNullSafe(newest[k]) for k in keys] + [rows["snapshot_at"] == newest["_qm_last"]]
    return rows.join(newest, same, "left_semi")


def listed(rows: DataFrame, k: int = 50) -> DataFrame:
    return rows.select("snapshot_at").distinct().orderBy(F.col("snapshot_at").desc()).limit(k)


def at_time(rows: DataFrame, when: Column, tolerance_s: float = 1.0) -> DataFrame:
    """The rows of the snapshot at a time: exact, or else the nearest within the tolerance (the earlier of two as near)."""
    off = F.abs(F.unix_micros("snapshot_at") - F.unix_micros(when))
    best = rows.filter(off < tolerance_s * 1e6).agg(F.min_by("snapshot_at", F.struct(off, F.col("snapshot_at"))).alias("_qm_at"))
    return rows.join(F.broadcast(best), F.col("snapshot_at") == F.col("_qm_at")).drop("_qm_at")


def compared(rows: DataFrame, times: Sequence[Column]) -> DataFrame:
    """The rows of several snapshots, by time, frequency and topic."""
    return rows.filter(F.col("snapshot_at").isin(*times)).orderBy("snapshot_at", F.col("frequency").desc(), "topic")


def changes(rows: DataFrame) -> DataFrame:
    """Each topic's frequency beside that of its dataset's snapshot before."""
    by = W.partitionBy("dataset_id", "topic").orderBy("snapshot_at")
    before = F.lag("frequency").over(by)
    return rows.withColumn("previous", before).withColumn("change", F.col("frequency") - F.coalesce(before, F.lit(0)))


def release_of(rows: DataFrame, version: str, content_hash: str):
    """The latest snapshot time of a release, or None."""
    return of_release(rows, version, content_hash).agg(F.max("snapshot_at").alias("at")).first().at


def latest_of_release(rows: DataFrame, version: str | None = None, content_hash: str | None = None, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """The rows of each key's latest snapshot among those of a release."""
    return latest(of_release(rows, version, content_hash), keys)


def verified(rows: DataFrame, dataset: str, when: Column, version: str | None = None, content_hash: str | None = None) -> bool:
    """Whether a dataset has a snapshot of a release at a time."""
    return not of_release(rows, version, content_hash).filter((F.col("dataset_id") == dataset) & (F.col("snapshot_at") == when)).isEmpty()


def deletion(rows: DataFrame, dataset: str, when: Column, dry_run: bool = True) -> tuple[str, int, DataFrame]:
    """(noop | not_found | dry_run | ok, rows concerned, what is left)."""
    if rows.isEmpty():
        return "noop", 0, rows
    gone = (F.col("dataset_id") == dataset) & (F.col("snapshot_at") == when)
    n = rows.filter(gone).count()
    if not n:
        return "not_found", 0, rows
    return ("dry_run", n, rows) if dry_run else ("ok", n, rows.filter(~F.coalesce(gone, F.lit(False))))
