"""Word lists: reading, merging, protecting, hashing, and the two filtered token columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strings
from .values import DOMAIN_STOPWORDS, EXPLORATION_STOPWORDS, TopicRules


def parse_lines(lines: Iterable[str]) -> list[str]:
    """Words, one a line: blank lines and # comments go, also after a word; lower case, each once, in order."""
    return merge(line.split("#", 1)[0] for line in lines)


def merge(*sources: Iterable[str] | None) -> list[str]:
    return list(dict.fromkeys(w for s in sources if s for w in (str(x).strip().lower() for x in s) if w))


def protected_terms(rules: TopicRules) -> list[str]:
    """Every word that a topic rule needs, which stop lists must not take."""
    return sorted(set(merge(*[(*t.phrases, *t.anchors, *t.negatives) for t in rules.topics])))


def effective(stop: Iterable[str], protected: Iterable[str]) -> list[str]:
    keep = set(merge(protected))
    return [w for w in merge(stop) if w not in keep]


def exploration(stop: Iterable[str], dataset: str | None) -> list[str]:
    """For keyword exploration: the built-in list is added and protected words are not taken out."""
    return merge(stop, EXPLORATION_STOPWORDS.get(dataset or "", ()))


def content_hash(words: Iterable[str]) -> str:
    """SHA-256 of the distinct lower-cased words, sorted, one a line."""
    return hashlib.sha256("\n".join(sorted(set(merge(words)))).encode()).hexdigest()


def content_hash_of(words: DataFrame, column: str) -> DataFrame:
    """One row, lexicon_hash: ``content_hash`` of a column."""
    word = F.lower(F.trim(column))
    return words.select(word.alias("w")).filter("w <> ''").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("w")), "\n"), 256).alias("lexicon_hash"))


def read_words(spark: SparkSession, path: str) -> list[str]:
    """A word list from any store that Spark reads; [] if there is none."""
    from pyspark.errors import AnalysisException

    try:
        return parse_lines(r.value for r in spark.read.text(path).collect())
    except AnalysisException:
        return []


@dataclass(frozen=True)
class Lexicon:
    """The stop lists of a dataset with their versions and hashes."""

    dataset: str | None
    release: tuple[str, ...]
    exploration: tuple[str, ...]
    release_version: str = "v1.0.0"
    exploration_version: str = "dev"

    @property
    def release_hash(self) -> str:
        return content_hash(self.release)

    @property
    def exploration_hash(self) -> str:
        return content_hash(self.exploration)


def collect(dataset: str | None, rules: TopicRules, words: Iterable[str] = ()) -> Lexicon:
    """A file's words and the built-in ones: protected words go from the release list, not from the exploration list."""
    merged = merge(words, sorted(DOMAIN_STOPWORDS.get(dataset or "", ())))
    return Lexicon(dataset, tuple(effective(merged, protected_terms(rules))), tuple(exploration(merged, dataset)))


def candidates(patterns: Iterable[str], dataset: str | None, version: str | None) -> list[str]:
    """The places to look for a word list, in order: patterns with {dataset_id} and {version} filled in where both are known."""
    out = []
    for p in patterns:
        if ("{dataset_id}" in p and not dataset) or ("{version}" in p and not version):
            continue
        out.append(p.replace("{dataset_id}", dataset or "").replace("{version}", version or ""))
    return list(dict.fromkeys(out))


def read_first(spark: SparkSession, paths: Iterable[str]) -> tuple[str | None, list[str]]:
    """(place, words) of the first of the ``candidates`` that has words; (None, []) if none has."""
    for path in paths:
        words = read_words(spark, path)
        if words:
            return path, words
    return None, []


def filter_tokens(tokens: Column, stop: Iterable[str]) -> Column:
    """Lower-cased tokens outside the list, each once."""
    lower = F.transform(F.coalesce(tokens, strings([])), lambda t: F.lower(F.trim(t)))
    return F.filter(F.array_except(lower, strings(merge(stop))), lambda t: t != "")


def with_lexicon_tokens(df: DataFrame, lexicon: Lexicon, tokens: str = "tokens") -> DataFrame:
    return df.withColumn("analytics_tokens", filter_tokens(F.col(tokens), lexicon.release)).withColumn(
        "tfidf_exploration_tokens", filter_tokens(F.col(tokens), lexicon.exploration)
    )


def token_column(df: DataFrame, explore: bool = False) -> str:
    """The best token column that is there."""
    order = (["tfidf_exploration_tokens"] if explore else []) + ["analytics_tokens", "tokens"]
    return next(c for c in order if c in df.columns)
