"""Row operators: latest row per key, duplicates, ingest gaps, change detection, and the rows that DML leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import dataset_of_path, display_time

#: The columns that tell a row's age, the first that is there.
TIMES = ("quarantined_at", "ingestion_timestamp", "etl_update_timestamp", "snapshot_at")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be made unique by the caller.

    A ``max_by`` over the whole row: partial aggregates before the shuffle, so a hot key costs one row a task.
    Orders are descending columns; nulls come last.
    """
    best = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_qm")).select("_qm.*").select(*df.columns)


def prepare_for_silver(bronze: DataFrame, dataset: str | None = None) -> DataFrame:
    """Of the rows with text the latest of each image_path: trimmed text, dataset from the given id or the path."""
    rows = bronze.filter("extracted_text is not null")
    order = [F.col("ingestion_timestamp"), F.col("file_hash"), F.col("extracted_text")]
    rows = latest_per_key(rows, ["image_path"], order).withColumn("extracted_text", F.trim("extracted_text"))
    rows = rows.withColumn("dataset_id", F.lit(dataset) if dataset else dataset_of_path(F.col("image_path")))
    return rows.withColumnRenamed("ingestion_timestamp", "latest_ingestion_timestamp")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: groups with more than one row, their rows beyond the first, and all their rows."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    zero = F.lit(0).cast("long")
    return n.agg(
        F.count(F.lit(1)).alias("duplicate_groups"), F.coalesce(F.sum(F.col("c") - 1), zero).alias("extra_rows"), F.coalesce(F.sum("c"), zero).alias("duplicate_rows")
    )


def skip_known(new: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are not known yet; keys are computed on both sides before the join."""
    return new.join(known.select(*keys).distinct(), keys, "left_anti")


def ingest_status(raw: DataFrame, bronze: DataFrame, key: str, text: str, preview: int = 160) -> DataFrame:
    """Raw objects with in_bronze and a preview of the text."""
    known = bronze.groupBy(key).agg(F.max(text).alias("_qm_text"), F.lit(True).alias("_qm_in"))
    short = F.when(F.length("_qm_text") > preview, F.concat(F.substring("_qm_text", 1, preview), F.lit("…"))).otherwise(F.col("_qm_text"))
    return raw.join(known, key, "left").select(*raw.columns, F.coalesce("_qm_in", F.lit(False)).alias("in_bronze"), short.alias("preview"))


def unchanged(version: str, null_safe: bool = True) -> Column:
    """Whether source row ``u`` is already in target row ``t``. Not null-safe, a null on either side makes it unknown."""
    same = lambda a, b: a.eqNullSafe(b) if null_safe else a == b
    out = F.col("t.image_path").isNotNull()
    for c in ("extracted_text", "cleaned_text", "source_bucket"):
        out &= same(F.col(f"u.{c}"), F.col(f"t.{c}"))
    out &= same(F.col("u.latest_ingestion_timestamp"), F.col("t.ingestion_timestamp"))
    out &= same(F.trim(F.lower("u.dataset_id")), F.trim(F.lower("t.dataset_id")))
    out &= F.trim(F.coalesce("t.cleaned_text", F.lit(""))) != ""
    out &= F.coalesce(F.size("t.tokens"), F.lit(0)) > 0
    out &= F.trim(F.coalesce("t.silver_transform_version", F.lit(""))) == version
    return out


def changed_rows(source: DataFrame, target: DataFrame, version: str, null_safe: bool = True) -> DataFrame:
    """Source rows that are new, differ, are stale or of another version; ``is_new`` tells inserts from updates."""
    joined = source.alias("u").join(target.alias("t"), F.col("u.image_path") == F.col("t.image_path"), "left")
    kept = joined.filter(~unchanged(version, null_safe))
    return kept.select("u.*", F.col("t.image_path").isNull().alias("is_new"))


def upserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after matched rows are replaced and the others inserted; missing columns become null on either side."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source, allowMissingColumns=True)


def archived(target: DataFrame, source: DataFrame, keys: list[str], reason: str = "pre_merge", at: Column | None = None) -> DataFrame:
    """The target's rows that an upsert is about to replace, stamped."""
    rows = target.join(source.select(*keys).distinct(), keys, "left_semi")
    return rows.withColumn("archived_at", at if at is not None else F.current_timestamp()).withColumn("archive_reason", F.lit(reason))


def without(target: DataFrame, condition: Column) -> DataFrame:
    """The rows that a delete leaves: an unknown condition deletes nothing."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def latest_batch_only(target: DataFrame, column: str) -> DataFrame:
    """Deletes what is older than the latest time; rows without a time stay, and all do if none has one."""
    newest = target.agg(F.max(F.to_timestamp(column)).alias("_qm_max"))
    older = F.to_timestamp(column) < F.col("_qm_max")
    return without(target.crossJoin(F.broadcast(newest)), older).drop("_qm_max")


def dataset_replaced(target: DataFrame, new: DataFrame, dataset: str | None) -> DataFrame:
    """A dataset's rows replaced by new ones; no new rows leave the table as it is; without a dataset all is replaced."""
    some = new.limit(1).agg((F.count(F.lit(1)) > 0).alias("_qm_some"))
    gone = (F.lit(True) if dataset is None else F.col("dataset_id") == dataset) & F.col("_qm_some")
    kept = without(target.crossJoin(F.broadcast(some)), gone).drop("_qm_some")
    return kept.unionByName(new, allowMissingColumns=True)


def of_images(df: DataFrame, paths: Sequence[str], few: int = 100) -> DataFrame:
    """The rows of the images named: a filter that reaches the scan for a few, a semi join for more."""
    paths = list(dict.fromkeys(p.strip() for p in paths if p and p.strip()))
    if len(paths) <= few:
        return df.filter(F.col("image_path").isin(*paths)) if paths else df.limit(0)
    return df.join(df.sparkSession.createDataFrame([(p,) for p in paths], "image_path string"), "image_path", "left_semi")


def preview(df: DataFrame, k: int = 20, *ties: str, descending: bool = True, score: tuple[str, ...] = ("tfidf_score", "total_tf"), most: int = 200) -> DataFrame:
    """The newest k rows (1 to ``most``), or the best by the first score there is where no time is; times as text to show."""
    ordered = [c for c in TIMES if c in df.columns] or [c for c in score if c in df.columns]
    if ordered:
        first = F.col(ordered[0])
        df = df.orderBy(first.desc_nulls_last() if descending else first.asc_nulls_last(), *ties)
    shown = {f.name: display_time(F.col(f.name).cast("timestamp")) for f in df.schema if f.dataType.typeName() in ("timestamp", "timestamp_ntz")}
    return df.limit(max(1, min(k, most))).withColumns(shown)


def with_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Missing columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def by_time(df: DataFrame, descending: bool = True) -> DataFrame:
    """Ordered by the first time column that is there, nulls last."""
    found = next((c for c in TIMES if c in df.columns), None)
    if found is None:
        return df
    return df.orderBy(F.col(found).desc_nulls_last() if descending else F.col(found).asc_nulls_last())
