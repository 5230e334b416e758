"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Method: a text's statistics (shares of kinds of characters, lengths, repetition) are counts, turned into
arcsine shares and logarithms so that each class is near a normal distribution. For either label a mean and a covariance are estimated,
the covariance shrunk towards the pooled variances, ``(1 - a) S_k + a diag(S)``, and factored once by Cholesky. A text's
log-density under a class is its Mahalanobis distance, by solving with the kept factor, and the log-determinant; the
score is the posterior of label 1 from the two log-densities and the class frequencies.

The fit takes all labelled rows given, no sample: tasks emit sums and products, Spark adds them up, and only those sums
(two classes, some hundred numbers) reach the driver. Statistics read whole texts.

Cases: a null text counts as empty; an empty one has the statistics of zero counts and gets a score like any other.
Rows without a label, or with a null one, are not learnt from; repeated labels of an id count once, as their largest.
With rows of one class only, or of none, every score is that class's frequency, or 0.5. A null id is scored, never
learnt from, and counts as held out. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved
from .memory import lean
from .shingles import runs, word_hashes

NAMES = (
    "words", "symbols", "upper", "digits", "shouts", "bars", "wide", "word_length", "length_spread", "stutter",
    "distinct", "top_word", "stops", "lines",
)
SHRINK, THRESHOLD = 0.1, 0.3

UPPER, LOWER, DIGIT, BLANK, LINE, STOP, SHOUT, BAR, WIDE, SYMBOL = range(10)


def _kinds() -> np.ndarray:
    kind = np.full(256, SYMBOL, np.int64)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = UPPER, LOWER, DIGIT, WIDE
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], kind[0x0A], kind[ord("!")], kind[ord("|")] = BLANK, LINE, SHOUT, BAR
    kind[[ord(c) for c in ".,;:'\"?()-"]] = STOP
    return kind


_KIND = _kinds()


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The variance-stabilised share of ``part``: none is 0 however short the text."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x NAMES): the transformed statistics of the texts of a run."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n) * 10, np.diff(offsets))
    kinds = np.bincount(text + _KIND[data], minlength=n * 10).reshape(n, 10).astype(float)
    hashes, starts, bounds = word_hashes(data, offsets)
    words = np.diff(bounds).astype(float)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    blank = np.concatenate([[0], np.cumsum((_KIND[data] == BLANK) | (_KIND[data] == LINE))])
    ends = np.minimum(np.append(starts[1:], len(data)), offsets[owner + 1]) if len(starts) else starts
    length = (ends - starts - (blank[ends] - blank[starts])).astype(float)
    total, square = (np.bincount(owner, w, n) for w in (length, length * length))
    mean = total / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(0.0, square / np.maximum(words, 1) - mean * mean))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    stutter = np.bincount(owner, same, n)
    distinct, top = np.zeros(n), np.zeros(n)
    for k in range(n):
        own = np.sort(hashes[bounds[k] : bounds[k + 1]])
        if len(own):
            cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
            distinct[k], top[k] = len(cuts) - 1, np.diff(cuts).max()
    letters = kinds[:, UPPER] + kinds[:, LOWER]
    seen = kinds.sum(axis=1) - kinds[:, BLANK] - kinds[:, LINE]
    return np.column_stack(
        [
            np.log1p(words),
            _share(kinds[:, SYMBOL], seen),
            _share(kinds[:, UPPER], letters),
            _share(kinds[:, DIGIT], seen),
            _share(kinds[:, SHOUT], seen),
            _share(kinds[:, BAR], seen),
            _share(kinds[:, WIDE], seen),
            np.log1p(mean),
            np.log1p(spread),
            _share(stutter, words),
            _share(distinct, words),
            _share(top - 1, words),
            _share(kinds[:, STOP], seen),
            _share(kinds[:, LINE], words),
        ]
    )


def _measured(batches):
    for batch in batches:
        for row, rows, data, offsets in runs(batch.column(1)):
            x = statistics(data, offsets)
            flat = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, rows), flat], names=["id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def _sums(batches):
    """(label, k, value): entry k of count, sum and sum of products of the rows of a label."""
    for batch in batches:
        y, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
        for label in (0, 1):
            rows = x[y == label]
            value = np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(value), label, np.int32)), pa.array(np.arange(len(value), dtype=np.int32)), pa.array(value)], names=["label", "k", "value"]
            )


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors and constants; ``constant`` where only one class is known."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    constant: float | None = None

    @classmethod
    def fit(cls, sums: dict[int, np.ndarray], shrink: float = SHRINK) -> Discriminant:
        d = len(NAMES)
        counts = [float(sums[k][0]) if k in sums else 0.0 for k in (0, 1)]
        if min(counts) < 2:
            return cls(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), counts[1] / sum(counts) if sum(counts) else 0.5)
        means = np.array([sums[k][1 : d + 1] / counts[k] for k in (0, 1)])
        covs = [sums[k][d + 1 :].reshape(d, d) / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)]
        pooled = np.maximum((counts[0] * np.diag(covs[0]) + counts[1] * np.diag(covs[1])) / sum(counts), 1e-6)
        factors, offsets = [], []
        for k in (0, 1):
            chol = np.linalg.cholesky((1 - shrink) * covs[k] + shrink * np.diag(pooled))
            factors.append(np.linalg.inv(chol))
            offsets.append(np.log(counts[k] / sum(counts)) - np.log(np.diag(chol)).sum())
        return cls(means, np.array(factors), np.array(offsets))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [self.offsets[k] - 0.5 * (((x - self.means[k]) @ self.factors[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every whole text."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(lean(_measured), "id long, x array<double>")


def fit(measured: DataFrame, labels: DataFrame, shrink: float = SHRINK) -> Discriminant:
    """``labels`` (id, label 0/1): all rows given are learnt from."""
    known = labels.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    rows = measured.join(known, "id").select("label", "x").mapInArrow(_sums, "label int, k int, value double")
    sums: dict[int, np.ndarray] = {}
    for r in rows.groupBy("label", "k").agg(F.sum("value").alias("value")).collect():  # a fixed number of sums
        sums.setdefault(r.label, np.zeros(1 + len(NAMES) + len(NAMES) ** 2))[r.k] = r.value
    return Discriminant.fit(sums, shrink)


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """(id, score): the posterior of label 1."""

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=["id", "score"])

    return measured.mapInArrow(scored, "id long, score double")


def held_out(id_: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; true for null."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _learnt(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").alias("label")).filter(~held_out(F.col("id")))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted; learns ``labels.quality`` of the rows that are not held out only."""
    measured = saved(measure(docs), "measured")
    out = score(measured, fit(measured, _learnt(labels)))
    return out.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted 0, each by its own text, whether or not it has an id of its own."""

    @F.arrow_udf("array<double>")
    def measures(texts: pa.Array) -> pa.Array:
        x = np.concatenate([np.zeros((0, len(NAMES))), *(statistics(data, offsets) for _, _, data, offsets in runs(texts))])
        return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES), pa.array(x.ravel()))

    @F.arrow_udf("boolean")
    def good(x: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(x)) >= threshold)

    rows = saved(docs.withColumn("_qm_x", measures("text")), "measured")
    model = fit(rows.select(F.col("doc_id").cast("long").alias("id"), F.col("_qm_x").alias("x")), _learnt(labels))
    return rows.filter(good("_qm_x")).select(*docs.columns)


def op9_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
