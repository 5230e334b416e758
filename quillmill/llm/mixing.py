"""Mixing sources to target weights along a time-varying curriculum.

Method: a source's weight is a schedule over training time t in [0, 1], here linear: ``w(t) = w * (1 + slope * (2t - 1))``
with a slope in [-1, 1] of its own. Its integral from 0 to t, ``w * ((1 - slope) * t + slope * t^2)``, is the share of
the source's token demand that is used up by time t. Every document covers a span of its source's cumulative tokens (in
the order of a hash of its id, pass after pass; rows without an id come last); the inverse of the integral at the span's start is the document's
training position, and the mix is the documents range-sorted by position.

Targets: the mix holds as many words as all documents. Sources share them by weight, but none above ``most`` times its
own words; the excess goes to the others by weight until none is above. This water level is exact: with the sources
sorted by ``most * size / weight``, those below the level are at their cap.

A document is taken once for each pass whose span begins before its source's demand ends (position 1); the last span is
cut there. So the words taken from a source are its target, rounded, and no document is taken above ``most`` times.

Cases: a null text has size 0 and takes nothing. A null source is a source of its own, sorted last. Repeated rows are
documents of their own. A source without words has target 0. An empty table gives an empty result. Only id, text and
source are read by ``allocate``; ``mix`` keeps all columns. No task sees a whole source or all sources: both are numbered
in two levels (see ``common.numbered``), and a hot source's target reaches its documents by a broadcast (``attach``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, drop, in_ranges, numbered, saved

#: Weights of the sources in code-point order, repeating, and the slopes of their schedules, likewise.
WEIGHTS, SLOPES, MOST = (1, 2, 3), (-0.5, 0.0, 0.5), 3


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size, ...), a row per source -> with weight, slope and target. Sources may be many: they
    are sorted in ranges, and only sums over ranges meet in one task."""
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.pmod("_qm_nr", F.lit(len(values))).cast("int") + 1)
    named = in_ranges(sizes.withColumn("_qm_one", F.lit(0)), [F.col("source").asc_nulls_last()], "mix-names")
    rows = numbered(named, "_qm_one", F.col("_qm_range"), [F.col("source").asc_nulls_last()], "_qm_nr").drop("_qm_range")
    rows = rows.withColumns({"weight": pick(weights), "slope": pick(slopes), "cap": F.col("source_size") * F.lit(float(most))})
    order = [F.col("cap") / F.col("weight"), F.col("_qm_nr")]
    by_cap = in_ranges(rows, order, "mix-caps")
    for amount in ("cap", "weight"):
        rows = numbered(by_cap if amount == "cap" else rows, "_qm_one", F.col("_qm_range"), order, f"_qm_{amount}", F.col(amount))
    sums = by_cap.agg(F.sum("source_size").cast("double").alias("_qm_all"), F.sum("weight").alias("_qm_weights"))
    # with one more source taken to be at its cap, the level rises for as long as that source really is
    level = (F.col("_qm_all") - F.col("_qm_cap")) / (F.col("_qm_weights") - F.col("_qm_weight"))
    level = rows.crossJoin(F.broadcast(sums)).agg(F.max(level).alias("_qm_level"))
    rows = by_cap.crossJoin(F.broadcast(level))
    own = [c for c in sizes.columns if c not in ("source", "source_size")]
    return rows.select("source", "source_size", *own, "weight", "slope", F.least("cap", F.col("_qm_level") * F.col("weight")).alias("target"))


def allocate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None, **options
) -> DataFrame:
    """A row per document: id_col, source, size, source_size, target, slope, start (its first token of the source), spans, taken.

    ``spans`` has the passes that take words of it: pass, words, position. ``row_col``, a column unique by row, goes along
    if it is given.
    """
    own = [F.col(row_col).alias("_qm_own")] if row_col else []
    # rows without an id come last, dealt by their texts: they may be a large part of a source
    h = F.coalesce(F.md5(F.col(id_col).cast("string")), F.concat(F.lit("g"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))
    rows = docs.select(
        F.col(id_col).alias("_qm_id"), F.col(source_col).alias("source"), key.alias("_qm_key"), word_count(F.col(text_col)).alias("size"), h.alias("_qm_h"), *own
    )
    rows = saved(rows, "mix-sizes")
    sizes = rows.groupBy("source", "_qm_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_qm_docs"))
    sources = saved(targets(sizes, **options).drop("source", "weight"), "mix-sources")
    chunk = F.substring("_qm_h", 1, 3)
    order = [F.col(c) for c in ("_qm_h", "_qm_id", "size", *(["_qm_own"] if row_col else []))]
    rows_of = numbered(rows, "_qm_key", chunk, order, "start", F.col("size"))
    placed = attach(saved(rows_of, "mix-starts"), sources, "_qm_key", "_qm_docs", rows.count())
    drop(rows)
    # span by span of the source's demand: what is left of the document's words where it begins
    at = lambda p: p * F.col("source_size") + F.col("start")
    words = lambda p: F.greatest(F.lit(0), F.least(F.col("size"), F.round("target").cast("long") - at(p)))
    when = lambda p: position(at(p) / F.greatest(F.lit(1.0), F.col("target")), F.col("slope"))
    passes = F.sequence(F.lit(0), F.lit(math.ceil(options.get("most", MOST)) - 1))
    spans = F.filter(F.transform(passes, lambda p: F.struct(p.alias("pass"), words(p).alias("words"), when(p).alias("position"))), lambda s: s["words"] > 0)
    placed = placed.withColumn("spans", spans)
    return placed.select(
        F.col("_qm_id").alias(id_col), "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "slope", "start", "spans",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"]).alias("taken"), *([F.col("_qm_own").alias(row_col)] if row_col else []),
    )


def position(used: Column, slope: Column) -> Column:
    """The time t at which the share ``used`` of a source's demand is used up: inverts (1 - s) t + s t^2 = used."""
    root = F.sqrt(F.greatest(F.lit(0.0), (1 - slope) * (1 - slope) + 4 * slope * used))
    return F.when((F.abs(slope) < 1e-12) | (used <= 0), used).otherwise(F.try_divide(2 * used, (1 - slope) + root))


def stream(allocation: DataFrame) -> DataFrame:
    """A row per document and pass that takes words of it: pass, words, position in [0, 1)."""
    rows = allocation.withColumn("_qm_span", F.explode("spans"))
    return rows.select(*[c for c in allocation.columns if c != "spans"], "_qm_span.*")


#: The stream is numbered in so many stretches of training time.
STRETCHES = 1 << 14


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """A row per document, in the order of training: id_col, size, source_size, target, taken, first_position, first_place.

    All of it comes from the stream in the order of positions: ``taken`` sums the words of a document's passes, and
    ``first_place`` is the number of its first one in the whole stream, from 0. Documents that are not taken come last.
    """
    rows = docs.select(F.col(id_col), F.col(text_col), F.col(source_col), F.monotonically_increasing_id().alias("_qm_row"))
    rows = saved(allocate(rows, id_col, text_col, source_col, "_qm_row", **options).withColumn("_qm_span", F.explode_outer("spans")), "mix-stream")
    rows = rows.select("*", F.col("_qm_span.position").alias("position"), F.col("_qm_span.words").alias("words"), F.lit(0).alias("_qm_one"))
    # what is not taken is numbered beside the stream, in chunks of its own, and adds nothing to it
    idle = F.lit(STRETCHES) + F.pmod(F.xxhash64("_qm_row"), F.lit(STRETCHES))
    chunk = F.when(F.col("words") > 0, F.least(F.floor(F.col("position") * STRETCHES), F.lit(STRETCHES - 1))).otherwise(idle).cast("int")
    order = [F.col("position"), F.md5(F.col(id_col).cast("string")), F.col(id_col), F.col("_qm_span.pass"), F.col("_qm_row")]
    rows = numbered(rows, "_qm_one", chunk, order, "place", F.when(F.col("words") > 0, 1).otherwise(0).cast("long"))
    first = lambda c: F.min(F.when(F.col("words") > 0, F.col(c)))
    out = rows.groupBy("_qm_row").agg(
        *[F.first(c).alias(c) for c in (id_col, "size", "source_size", "target")], F.coalesce(F.sum("words"), F.lit(0)).alias("taken"),
        first("position").alias("first_position"), first("place").alias("first_place"),
    )
    return saved(out.drop("_qm_row"), "mix-schedule").orderBy(F.col("first_place").asc_nulls_last(), id_col)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The training stream: the rows of ``docs``, each as often as passes take it, range-sorted by position.

    A document that the last pass takes in part is there whole, since texts are never cut. Rows are numbered before they
    are joined to the plan, so rows without an id and rows that repeat one are each taken as often as the plan says.
    """
    rows = saved(docs.withColumn("_qm_row", F.monotonically_increasing_id()), "mix-rows")
    plan = stream(allocate(rows, id_col, text_col, source_col, "_qm_row", **options))
    plan = saved(plan.select(F.col("_qm_row").alias("_qm_own"), "position", "pass"), "mix-plan")
    plan = plan.withColumnsRenamed({"position": "_qm_position", "pass": "_qm_pass"})
    order = ["_qm_position", id_col, "_qm_row", "_qm_pass"]
    rows = rows.join(plan, F.col("_qm_row") == F.col("_qm_own"))
    return rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).select(*docs.columns)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = schedule(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.withColumns({"target": F.round("target", 3), "first_position": F.round("first_position", 9)})


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nr FROM d GROUP BY source
), w AS (
  SELECT *, (1 + nr % 3)::DOUBLE AS weight, (nr % 3 - 1) * 0.5::DOUBLE AS slope, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER () AS total FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, nr)
), f AS (
  SELECT *, max(level) OVER () AS final FROM l
), t AS (
  SELECT *, least(cap, final * weight) AS target FROM f
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, (pass * source_size + start) / greatest(1.0::DOUBLE, target) AS used,
    greatest(0, least(size, round(target)::BIGINT - (pass * source_size + start)))::BIGINT AS words FROM r, (VALUES (0), (1), (2)) p(pass)
), m AS (
  SELECT *, CASE WHEN abs(slope) < 1e-12 OR used <= 0 THEN used
    ELSE 2 * used / ((1 - slope) + sqrt(greatest(0.0::DOUBLE, (1 - slope) * (1 - slope) + 4 * slope * used))) END AS position FROM k WHERE words > 0
), o AS (
  SELECT *, row_number() OVER (ORDER BY position, md5(doc_id::VARCHAR), doc_id, pass) - 1 AS place FROM m
), g AS (
  SELECT doc_id, sum(words)::BIGINT AS taken, min(position) AS first_position, min(place) AS first_place FROM o GROUP BY doc_id
)
SELECT r.doc_id, r.size, r.source_size, round(r.target, 3) AS target, coalesce(g.taken, 0)::BIGINT AS taken, round(g.first_position, 9) AS first_position, g.first_place
FROM r LEFT JOIN g USING (doc_id)
"""
