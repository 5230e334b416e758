"""File access through Hadoop's file system API, so any store that Spark reads will do, and the scans on it."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import IMAGE_NAME, dataset_of_path, image_kind


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _at(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} cannot be moved to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; [] if there is none."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors see: under ``spark.checkpoint.dir``, or a temporary one in a local session."""
    import tempfile
    import uuid

    at = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not at and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set")
    return f"{at.rstrip('/') or 'file:' + tempfile.mkdtemp(prefix='quillmill-')}/quillmill-{uuid.uuid4().hex}"


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> dict:
    """A JSON object (a manifest, a state); {} if there is none; other JSON raises."""
    if not exists(spark, path):
        return {}
    doc = json.loads(read_text(spark, path))
    if not isinstance(doc, dict):
        raise ValueError(f"{path} holds no object")
    return doc


def write_json(spark: SparkSession, path: str, doc: dict) -> None:
    write_text(spark, path, json.dumps(doc, ensure_ascii=False, indent=1, sort_keys=True))


def images(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """image_path and, if asked for, image_content of the images under a path. Without content, files are not read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(F.lower("path").rlike(IMAGE_NAME))
    return raw.select(F.col("path").alias("image_path"), *([F.col("content").alias("image_content")] if content else []))


def real_images(df: DataFrame) -> DataFrame:
    """Those whose first bytes are an image's."""
    return df.filter(image_kind(F.col("image_content")).isNotNull())


def image_listing(spark: SparkSession, path: str) -> DataFrame:
    """image_path, dataset_id, size, last_modified; from the listing alone."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(F.lower("path").rlike(IMAGE_NAME))
    return raw.select(F.col("path").alias("image_path"), dataset_of_path(F.col("path")).alias("dataset_id"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def count_images(spark: SparkSession, path: str, at_most: int | None = None) -> int:
    """How many images there are, or at_most of them; 0 where there is no such path."""
    if not exists(spark, path):
        return 0
    rows = images(spark, path, content=False)
    return (rows.limit(at_most) if at_most else rows).count()


def datasets(listing: DataFrame) -> DataFrame:
    return listing.filter("dataset_id <> ''").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("images"))


def first_images(spark: SparkSession, path: str, k: int) -> DataFrame:
    """The k first by path, with their size: a preview."""
    return image_listing(spark, path).orderBy("image_path").limit(min(k, 50)).select("image_path", "size")


def sample_with_content(spark: SparkSession, path: str, k: int) -> DataFrame:
    """The k first images by path, with content: names are sorted first, and only the chosen files are read."""
    chosen = [r.image_path for r in images(spark, path, content=False).orderBy("image_path").limit(min(k, 50)).collect()]
    raw = spark.read.format("binaryFile").load(chosen) if chosen else spark.read.format("binaryFile").load(path).limit(0)
    return real_images(raw.select(F.col("path").alias("image_path"), F.col("content").alias("image_content")))


def records(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A table of given records, types by their values; none raises."""
    if not rows:
        raise ValueError("no records")
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], names)


def batches(paths: Sequence[str], size: int, most: int) -> list[list[str]]:
    """Paths without blanks in batches of min(size, most), 1 at least."""
    paths = [p.strip() for p in paths if p and p.strip()]
    n = max(1, min(size, most))
    return [paths[i : i + n] for i in range(0, len(paths), n)]


METRIC_SCHEMA = "etl_name string, dataset_id string, status string, duration_ms double, recorded_at string, melted boolean, blocked boolean, detail string, _corrupt string"


def append_metric(spark: SparkSession, folder: str, metric: dict) -> None:
    """One JSON line a file: appends by many drivers never meet."""
    import uuid
    from datetime import UTC, datetime

    doc = {"recorded_at": datetime.now(UTC).isoformat()} | metric
    write_text(spark, f"{folder}/{doc['recorded_at'].replace(':', '')}-{uuid.uuid4().hex}.json", json.dumps(doc, ensure_ascii=False) + "\n")


def read_metrics(spark: SparkSession, folder: str, limit: int = 100, dataset: str | None = None, name: str | None = None) -> DataFrame:
    """The newest metrics (1000 at most); lines that are no JSON are passed over."""
    rows = spark.read.schema(METRIC_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    rows = rows.filter(F.col("_corrupt").isNull() & F.col("etl_name").isNotNull()).drop("_corrupt")
    for column, value in (("dataset_id", dataset), ("etl_name", name)):
        if value:
            rows = rows.filter(F.col(column) == value)
    return rows.orderBy(F.col("recorded_at").desc(), "etl_name").limit(max(1, min(limit, 1000)))
