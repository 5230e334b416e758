"""Streaming forms: incremental upserts, windowed counts with watermarks, and duplicates within a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import rows
from ..sources.store import TableStore


def upsert_stream(source: DataFrame, store: TableStore, table: str, keys: list[str], order: list[str], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataStreamWriter:
    """Each batch: prepared, reduced to the latest row a key, upserted. Batches redone after a failure change nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        batch = prepare(batch) if prepare else batch
        if not batch.isEmpty():
            store.upsert(table, rows.latest_per_key(batch, keys, [F.col(c) for c in order]), keys)

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def tumbling(events: DataFrame, time: str, keys: list[str], size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of ``value`` by window and keys; on a stream, windows close once the watermark is past them."""
    rows_ = events.withWatermark(time, late) if events.isStreaming else events
    out = rows_.groupBy(F.window(time, size), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of events of a key no further apart than the gap."""
    rows_ = events.withWatermark(time, late) if events.isStreaming else events
    out = rows_.groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *keys, "n")


def distinct_within(events: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark's delay; state older than that is dropped."""
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
