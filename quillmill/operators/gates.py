"""Gates: quarantine of rows with a circuit breaker, data quality in one pass, and warnings about results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_noise, text_status
from .values import HARD_REJECT, QUALITY, SOFT_REJECT


class GateError(RuntimeError):
    """A gate that stops a run; ``detail`` is its verdict."""

    def __init__(self, message: str, detail: object):
        super().__init__(message)
        self.detail = detail


def with_status(df: DataFrame, text: str = "extracted_text", **options) -> DataFrame:
    return df.withColumn("ocr_status", text_status(F.col(text), **options))


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("ocr_status").agg(F.count(F.lit(1)).alias("n"))


def quarantine_summary(df: DataFrame) -> DataFrame:
    """One row: total_rows, ok_rows, reject_rows, reject_rate (0 for no rows)."""
    ok = F.count(F.when(F.col("ocr_status") == "ok", 1))
    total = F.count(F.lit(1))
    return df.agg(total.alias("total_rows"), ok.alias("ok_rows"), (total - ok).alias("reject_rows"), F.coalesce(F.try_divide(total - ok, total), F.lit(0.0)).alias("reject_rate"))


def melt_column(total, rate, mode: str = "soft", soft: float = SOFT_REJECT, hard: float = HARD_REJECT):
    """pass, soft or hard; at the soft rate exactly it passes, at the hard rate exactly it is hard."""
    over = F.lit("hard" if mode == "hard" else "soft")
    return F.when(total <= 0, "pass").when(rate >= hard, "hard").when(rate > soft, over).otherwise("pass")


def melt_decision(total: int, rejects: int, mode: str = "soft", soft: float = SOFT_REJECT, hard: float = HARD_REJECT) -> dict:
    rate = rejects / total if total > 0 else 0.0
    if total <= 0:
        level, reason = "pass", "no_rows"
    elif rate >= hard:
        level, reason = "hard", "hard_reject_rate"
    elif rate > soft:
        level, reason = ("hard", "manual_hard_mode") if mode == "hard" else ("soft", "soft_reject_rate")
    else:
        level, reason = "pass", "below_soft_reject_rate"
    return {"level": level, "reason": reason, "total_rows": total, "reject_rows": rejects, "reject_rate": rate, "melted": level != "pass", "blocked": level == "hard"}


def rejected(df: DataFrame, source_path: str) -> DataFrame:
    """The rows for the quarantine table."""
    names = ("image_path", "extracted_text", "ocr_status", "ingestion_timestamp", "source_bucket", "ocr_signature", "dataset_id")
    rows = df.filter("ocr_status <> 'ok'")
    return rows.select(*[c for c in names if c in df.columns], F.current_timestamp().alias("quarantined_at"), F.lit(source_path).alias("bronze_source_path"))


def quarantine(df: DataFrame, write=None, source_path: str = "", mode: str = "soft", **options) -> tuple[DataFrame, dict]:
    """Tags rows, writes the rejects, decides: (ok rows, decision), or GateError if it is hard."""
    tagged = with_status(df, **options)
    row = quarantine_summary(tagged).first()
    if write is not None and row.reject_rows:
        write(rejected(tagged, source_path))
    decision = melt_decision(row.total_rows, row.reject_rows, mode)
    if decision["blocked"]:
        raise GateError(f"quarantine: {decision['reject_rate']:.1%} of rows are rejected", decision)
    return tagged.filter("ocr_status = 'ok'").drop("ocr_status"), decision


def snapshot_allowed(metrics: Iterable[Mapping], dataset: str) -> None:
    """Raises if the dataset's latest silver run was melted or blocked."""
    runs = [m for m in metrics if m.get("etl_name") == "silver_ocr_etl" and m.get("dataset_id") == dataset]
    last = max(runs, key=lambda m: str(m.get("recorded_at", "")), default=None)
    if last and (last.get("melted") or last.get("blocked")):
        raise GateError(f"the latest silver run of {dataset} was stopped or marked by the quarantine", dict(last))


def quality_metrics(silver: DataFrame, key: str = "image_path", long_token: int = 10) -> DataFrame:
    """One row with all measures. Duplicates take a shuffle by key; all the rest is one pass of conditional sums."""
    text, clean, tokens = F.col("extracted_text"), F.col("cleaned_text"), F.coalesce("tokens", F.array().cast("array<string>"))
    count = lambda c: F.count(F.when(c, 1))
    blank = F.trim(F.coalesce(clean, F.lit(""))) == ""
    size = F.length(F.trim(F.coalesce(text, F.lit(""))))
    kept = F.when(size == 0, 1.0).otherwise(F.try_divide(F.length(F.trim(F.coalesce(clean, F.lit("")))).cast("double"), size))
    digits = F.exists(F.split(F.coalesce(clean, F.lit("")), " "), lambda p: p.rlike(r"^\p{Nd}+$"))
    total = F.count(F.lit(1))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    zero = F.lit(0).cast("long")
    with_size = lambda f: F.coalesce(F.sum(F.size(F.filter(tokens, f)).cast("long")), zero)
    one = silver.agg(
        total.alias("total_rows"),
        count(F.col(key).isNull()).alias("null_image_path_rows"),
        count(text.isNull()).alias("null_extracted_text_rows"),
        count(clean.isNull()).alias("null_cleaned_text_rows"),
        count(is_noise(clean)).alias("noise_cleaned_text_rows"),
        count(digits).alias("pure_digit_token_in_cleaned_rows"),
        F.coalesce(F.sum(F.size(tokens).cast("long")), zero).alias("total_token_instances"),
        with_size(lambda t: F.length(t) == 1).alias("len1_token_instances"),
        with_size(lambda t: F.length(t) > long_token).alias("long_token_instances"),
        ratio(count(blank), total).alias("empty_cleaned_text_ratio"),
        ratio(count(F.size(tokens) > 0), total).alias("nonempty_tokens_ratio"),
        F.coalesce(F.avg(kept), F.lit(1.0)).alias("avg_char_retention"),
    )
    groups = silver.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return one.crossJoin(F.broadcast(groups.agg(F.coalesce(F.sum("c"), zero).alias("duplicate_image_path_rows"))))


def row_metrics(silver: DataFrame, long_token: int = 10) -> DataFrame:
    """The quality measures of each row: lengths, retention, share of characters in tokens, short and long tokens, noise, digits."""
    text, clean = F.coalesce("extracted_text", F.lit("")), F.coalesce("cleaned_text", F.lit(""))
    tokens = F.filter(F.transform(F.coalesce("tokens", F.array().cast("array<string>")), lambda t: F.trim(t)), lambda t: t != "")
    chars = F.aggregate(tokens, F.lit(0), lambda n, t: n + F.length(t))
    of = lambda f: F.size(F.filter(tokens, f))
    return silver.select(
        "image_path",
        F.length(text).alias("extracted_len"),
        F.length(clean).alias("cleaned_len"),
        F.size(tokens).alias("token_count"),
        F.coalesce(F.try_divide(F.length(clean), F.length(text)), F.lit(1.0)).alias("char_retention"),
        F.coalesce(F.try_divide(chars, F.length(clean)), F.lit(0.0)).alias("token_char_coverage"),
        of(lambda t: F.length(t) == 1).alias("len1_token_count"),
        of(lambda t: F.length(t) > long_token).alias("long_token_count"),
        is_noise(clean).alias("has_noise"),
        F.exists(F.split(clean, " "), lambda p: p.rlike(r"^\p{Nd}+$")).alias("has_digit_token"),
    )


@dataclass
class Verdict:
    passed: bool
    failures: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def quality_verdict(m: Mapping, limits: Mapping[str, float] = QUALITY) -> Verdict:
    """Hard: duplicates, nulls, noise beyond the limit, digit tokens. Warnings: the ratios. No rows pass with a warning."""
    total = m["total_rows"]
    if not total:
        return Verdict(True, [], ["no_rows"])
    out = Verdict(True)
    for name in ("duplicate_image_path_rows", "null_image_path_rows", "null_extracted_text_rows", "null_cleaned_text_rows", "pure_digit_token_in_cleaned_rows"):
        if m[name]:
            out.failures.append(name)
    if m["noise_cleaned_text_rows"] / total > limits["noise_ratio"]:
        out.failures.append("noise_cleaned_text_rows")
    tokens = m["total_token_instances"]
    checks = {
        "len1_token_ratio": tokens and m["len1_token_instances"] / tokens > limits["len1_ratio"],
        "long_token_ratio": tokens and m["long_token_instances"] / tokens > limits["long_ratio"],
        "empty_cleaned_text_ratio": m["empty_cleaned_text_ratio"] > limits["empty_cleaned_ratio"],
        "nonempty_tokens_ratio": m["nonempty_tokens_ratio"] < limits["nonempty_tokens_ratio"],
        "avg_char_retention": m["avg_char_retention"] < limits["char_retention"],
    }
    out.warnings += [k for k, bad in checks.items() if bad]
    out.passed = not out.failures
    return out


def quality_gate(silver: DataFrame, enabled: bool = True) -> Verdict | None:
    if not enabled:
        return None
    verdict = quality_verdict(quality_metrics(silver).first().asDict())
    if not verdict.passed:
        raise GateError(f"data quality: {', '.join(verdict.failures)}", verdict)
    return verdict


def gold_warnings(top_keywords: Iterable[str], stop: Iterable[str], docs: int, topics: int) -> list[str]:
    """Warnings only: no keywords; exploration stop words among the first ten; five documents or more but no topic."""
    first, stop = list(top_keywords)[:10], set(stop)
    out = [] if first else ["tfidf_empty"]
    out += [f"stopword_leak:{w}" for w in first if w in stop]
    return out + (["no_topics"] if docs >= 5 and not topics else [])
