"""A table store over Parquet: versions in folders, a pointer that names the current one, DML by staged rewrite.

A write goes to a new version folder and then replaces the pointer file, so a reader sees the old version or the new
one, and no path is overwritten while it is read. ``append`` adds to the current version. Versions no longer pointed to
are removed by ``vacuum``. One writer a table at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rows as ops
from . import files


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/_current"

    def current(self, name: str) -> str | None:
        at = self._pointer(name)
        return f"{self.root}/{name}/{files.read_text(self.spark, at).strip()}" if files.exists(self.spark, at) else None

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def read(self, name: str, ignore_missing: bool = False) -> DataFrame:
        """The current version; columns of all its files. ``ignore_missing`` holds for this read alone."""
        path = self.current(name)
        if path is None:
            raise FileNotFoundError(f"no table {name}")
        return self.spark.read.option("mergeSchema", "true").option("ignoreMissingFiles", str(ignore_missing).lower()).parquet(path)

    def overwrite(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        version = f"v-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.root}/{name}/{version}")
        files.write_text(self.spark, self._pointer(name), version)

    def append(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        path = self.current(name)
        if path is None:
            self.overwrite(name, df, partition_by)
        else:
            df.write.mode("append").partitionBy(*partition_by).parquet(path)

    def rewrite(self, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        self.overwrite(name, change(self.read(name)))

    def upsert(self, name: str, source: DataFrame, keys: list[str]) -> None:
        if self.exists(name):
            self.rewrite(name, lambda t: ops.upserted(t, source, keys))
        else:
            self.overwrite(name, source)

    def delete(self, name: str, condition: str | Column) -> None:
        condition = F.expr(condition) if isinstance(condition, str) else condition
        self.rewrite(name, lambda t: ops.without(t, condition))

    def keep_latest_batch(self, name: str, column: str) -> None:
        self.rewrite(name, lambda t: ops.latest_batch_only(t, column))

    def replace_dataset(self, name: str, df: DataFrame, dataset: str | None) -> None:
        """A dataset's rows for new ones, stamped analyzed_at; no new rows leave the old ones."""
        df = df.withColumn("analyzed_at", F.current_timestamp())
        df = df.withColumn("dataset_id", F.lit(dataset)) if dataset else df
        if self.exists(name):
            self.rewrite(name, lambda t: ops.dataset_replaced(t, df, dataset if "dataset_id" in t.columns else None))
        elif not df.isEmpty():
            self.overwrite(name, df)

    def add_columns(self, name: str, columns: dict[str, str]) -> None:
        if set(columns) - set(self.read(name).columns):
            self.rewrite(name, lambda t: ops.with_columns(t, columns))

    def write(self, name: str, df: DataFrame, mode: str, keys: list[str] | None = None, history: str | None = None) -> None:
        """append, overwrite or merge; a merge archives the rows it replaces in ``history`` if one is named."""
        if mode == "append":
            self.append(name, df)
        elif mode == "overwrite":
            self.overwrite(name, df)
        elif mode == "merge" and keys:
            if history and self.exists(name):
                self.append(history, ops.archived(self.read(name), df, keys))
            self.upsert(name, df, keys)
        else:
            raise ValueError(f"mode {mode!r}: append, overwrite, or merge with keys")

    def dedupe(self, name: str, keys: list[str], order: list[Column], dry_run: bool = True) -> dict:
        table = self.read(name)
        kept = ops.latest_per_key(table, keys, order)
        before, after = table.count(), kept.count()
        if before > after and not dry_run:
            self.overwrite(name, kept)
        return {"before": before, "after": after, "dropped": before - after, "dry_run": dry_run}

    def verify(self, name: str, condition: str) -> int:
        """Reads back strictly: how many rows meet a condition; none raises."""
        n = self.read(name).filter(condition).count()
        if not n:
            raise RuntimeError(f"{name}: what was written cannot be read back")
        return n

    def vacuum(self, name: str) -> list[str]:
        live = (self.current(name) or "").rsplit("/", 1)[-1]
        dead = [c for c in files.children(self.spark, f"{self.root}/{name}") if c.startswith("v-") and c != live]
        for c in dead:
            files.delete(self.spark, f"{self.root}/{name}/{c}")
        return dead
