"""Corpus statistics: TF-IDF keywords, bigrams, PMI phrases, top tokens. One shuffle by term each; totals are one-row joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import bigrams


def _counts(docs: DataFrame, doc: str, tokens: str, repeats: bool) -> DataFrame:
    """doc, keyword, n, marks: how often a keyword occurs (with ``repeats`` in each document, else doc is null).

    A document with a token left adds a row without a keyword, so that keywords and documents are counted in one pass: rows
    with marks stand for documents. Both kinds are told apart by ``marks``, an aggregate, and never by a grouping column,
    whose filter would go below the exchange and undo its reuse.
    """
    kept = docs.select(F.col(doc).alias("doc"), F.filter(tokens, lambda t: t.isNotNull() & (t != "")).alias("kept"))
    marked = F.when(F.col("doc").isNotNull() & (F.size("kept") > 0), F.concat("kept", F.array(F.lit(None).cast("string")))).otherwise(F.col("kept"))
    terms = kept.select("doc", F.explode(marked).alias("keyword"))
    by = F.col("doc") if repeats else F.when(F.col("keyword").isNull(), F.col("doc"))
    terms = terms.select(by.alias("doc"), "keyword")
    return terms.groupBy("doc", "keyword").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("keyword").isNull().cast("int")).alias("marks"))


def _stats(counts: DataFrame, repeats: bool) -> DataFrame:
    terms = counts.filter("marks = 0")
    if not repeats:
        return terms.select("keyword", F.col("n").alias("total_tf"), F.col("n").alias("doc_frequency"))
    return terms.groupBy("keyword").agg(F.sum("n").alias("total_tf"), F.count(F.lit(1)).alias("doc_frequency"))


def term_stats(docs: DataFrame, doc: str, tokens: str, repeats: bool = False) -> DataFrame:
    """keyword, total_tf, doc_frequency. Without ``repeats`` a document's tokens are distinct, and one count serves for both."""
    return _stats(_counts(docs, doc, tokens, repeats), repeats)


def tfidf(docs: DataFrame, doc: str, tokens: str, repeats: bool = False) -> DataFrame:
    """keyword, total_tf, doc_frequency, corpus_doc_count, idf = ln((N+1)/(df+1)), tfidf_score = total_tf * idf.

    N counts the documents with a token left. It is one row, so the join is a broadcast of fixed size. Texts are read and
    cleaned once: both sides use the same exchange.
    """
    counts = _counts(docs, doc, tokens, repeats)
    # n is asked for as well, or else it would be pruned here and the exchange not be the same
    n = counts.filter("marks > 0 and n > 0").agg(F.count(F.lit(1)).alias("corpus_doc_count"))
    idf = F.log((F.col("corpus_doc_count") + 1.0) / (F.col("doc_frequency") + 1.0))
    stats = _stats(counts, repeats).crossJoin(F.broadcast(n))
    return stats.withColumn("idf", idf).withColumn("tfidf_score", F.col("total_tf") * F.col("idf"))


def bigram_counts(docs: DataFrame, tokens: str) -> DataFrame:
    """word1, word2, bigram_count over the documents with two tokens or more."""
    pairs = docs.filter(F.size(tokens) >= 2).select(F.explode(bigrams(F.col(tokens))).alias("p")).select("p.word1", "p.word2")
    return pairs.filter("word1 <> '' and word2 <> ''").groupBy("word1", "word2").agg(F.count(F.lit(1)).alias("bigram_count"))


def phrase_pmi(docs: DataFrame, tokens: str, least: int = 2) -> DataFrame:
    """word1, word2, phrase, bigram_count, pmi_score = ln(p_xy / (p_x p_y)), total_bigrams.

    Marginals are by position and counted before ``least`` is applied. Those of the pairs that remain only are joined.
    """
    pairs = bigram_counts(docs, tokens)
    total = pairs.agg(F.sum("bigram_count").alias("total_bigrams"))
    first = pairs.groupBy("word1").agg(F.sum("bigram_count").alias("n1"))
    second = pairs.groupBy("word2").agg(F.sum("bigram_count").alias("n2"))
    kept = pairs.filter(F.col("bigram_count") >= max(1, least)).join(first, "word1").join(second, "word2").crossJoin(F.broadcast(total))
    n = F.col("total_bigrams").cast("double")
    pmi = F.log((F.col("bigram_count") / n) / ((F.col("n1") / n) * (F.col("n2") / n)))
    return kept.select("word1", "word2", F.concat_ws(" ", "word1", "word2").alias("phrase"), "bigram_count", pmi.alias("pmi_score"), "total_bigrams")


def top(df: DataFrame, score: str, k: int, *ties: str, most: int = 200) -> DataFrame:
    """The k best rows (1 to ``most``) by a score, then by unique columns: one top-k pass, no full sort."""
    return df.orderBy(F.col(score).desc_nulls_last(), *ties).limit(max(1, min(k, most)))


def top_tokens(docs: DataFrame, tokens: str, k: int = 50) -> DataFrame:
    counts = docs.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "token").limit(k)
