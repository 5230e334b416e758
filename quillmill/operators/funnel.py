"""The topic funnel: a review's tokens -> complaint topics, candidates and sentiment, by rules given as data.

``analyse`` is the whole funnel with fuzzy matching, run over columns by one Arrow UDF. ``exact_topics`` is the same
without fuzzy matching in column expressions alone, so it stays in generated code.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import phrase_hit, word_hit
from ..functions.text import strings
from .values import DRINKS, FUZZY_ANCHOR_RATIO, FUZZY_MIN_CHARS, FUZZY_RATIO, Topic, TopicRules

RESULT = "sentiment string, pain_topics array<string>, pain_candidates array<string>, filtered_out array<string>"


class Funnel:
    def __init__(self, rules: TopicRules = DRINKS, fuzzy: bool = True, ratio: float = FUZZY_RATIO, anchor_ratio: float = FUZZY_ANCHOR_RATIO, min_chars: int = FUZZY_MIN_CHARS):
        self.rules, self.fuzzy, self.ratio, self.anchor_ratio, self.min_chars = rules, fuzzy, ratio, anchor_ratio, min_chars
        # a recall seed that only names the subject of a topic recalled by complaint alone is no sign of one
        self.seeds = {
            t.name: sorted({*t.phrases, *((*t.anchors, *t.negatives) if t.recall_by_polarity else ())} - ({*t.anchors} if not t.recall_by_polarity else set()))
            for t in rules.topics
        }
        self.all_negatives = list(dict.fromkeys([*rules.negatives, *[n for t in rules.topics if t.anchors for n in t.negatives]]))

    def _has(self, words: Sequence[str], spaced: str, joined: str, hint: str, least: float | None) -> bool:
        if hint in spaced or hint in joined:
            return True
        if least is None or not self.fuzzy or len(hint) < self.min_chars:
            return False
        if any(len(w) >= self.min_chars and word_hit(w, hint, least, self.min_chars) for w in words):
            return True
        return phrase_hit(joined, hint, least, self.min_chars)

    def _stated(self, joined: str, term: str) -> bool:
        """Whether a term stands somewhere without a negation right before it."""
        at = joined.find(term)
        while at >= 0:
            if at == 0 or joined[at - 1] not in self.rules.negations:
                return True
            at = joined.find(term, at + len(term))
        return False

    def _polarity(self, t: Topic, words: Sequence[str], distinct: Sequence[str], spaced: str, joined: str) -> bool:
        if not t.anchors or not t.negatives:
            return False
        if not any(self._has(distinct, spaced, joined, n, None) for n in t.negatives):
            return False
        if not any(self._has(distinct, spaced, joined, a, self.anchor_ratio) for a in t.anchors):
            return False
        bad = [i for i, w in enumerate(words) if w in t.negatives]
        if bad:
            near = [i for i, w in enumerate(words) if any(abs(i - k) <= t.word_gap for k in bad)]
            for i in near:
                w = words[i]
                if any(a in w or w in a or (self.fuzzy and len(a) >= self.min_chars and word_hit(w, a, self.anchor_ratio, self.min_chars)) for a in t.anchors):
                    return True
        one, other = ("|".join(map(re.escape, x)) for x in (t.anchors, t.negatives))
        return bool(re.search(rf"(?:{one}).{{0,{t.char_gap}}}(?:{other})|(?:{other}).{{0,{t.char_gap}}}(?:{one})", joined))

    def analyse(self, tokens: Sequence[str] | None) -> tuple[str, list[str], list[str], list[str]]:
        """(sentiment, topics, candidates, filtered out)."""
        words = [w for w in (str(t).strip().lower() for t in (tokens if tokens is not None else ())) if w]
        if not words:
            return "neutral", [], [], []
        rules, spaced, joined = self.rules, " ".join(words), "".join(words)
        distinct = list(dict.fromkeys(words))
        negative = any(p in joined for p in rules.good_bad) or any(self._stated(joined, n) for n in self.all_negatives)

        def confirmed(hint: str) -> bool:
            if not self._has(distinct, spaced, joined, hint, self.ratio):
                return False
            if hint in rules.negation_aware:
                return self._stated(joined, hint)
            return negative if hint in rules.weak else True

        topics, recalled = [], []
        for t in rules.topics:
            if any(self._has(distinct, spaced, joined, s, self.anchor_ratio) for s in self.seeds[t.name]):
                recalled.append(t.name)
            if any(confirmed(h) for h in t.phrases) or self._polarity(t, words, distinct, spaced, joined):
                topics.append(t.name)
        if topics or negative:
            sentiment = "negative"
        else:
            sentiment = "positive" if any(self._has(distinct, spaced, joined, p, self.ratio) for p in rules.positives) else "neutral"
        return sentiment, topics, recalled, [t for t in recalled if t not in topics]


def analysis(tokens: Column, **options) -> Column:
    """STRUCT<sentiment, pain_topics, pain_candidates, filtered_out> of a token column."""
    funnel = Funnel(**options)

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [funnel.analyse(t) for t in s]
            yield pd.DataFrame(rows, columns=["sentiment", "pain_topics", "pain_candidates", "filtered_out"])

    return run(tokens)


def _any(columns) -> Column:
    out = F.lit(False)
    for c in columns:
        out |= c
    return out


def _near_words(words: Column, t: Topic) -> Column:
    """Whether an anchor word and a negative word are at most the topic's gap apart."""

    def at(test) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull())

    anchors = at(lambda w: _any([F.contains(w, F.lit(a)) | F.contains(F.lit(a), w) for a in t.anchors]))
    bad = at(lambda w: w.isin(*t.negatives))
    return F.exists(anchors, lambda i: F.exists(bad, lambda k: F.abs(i - k) <= t.word_gap))


def exact_topics(tokens: Column, rules: TopicRules = DRINKS) -> Column:
    """The topics that the funnel confirms without fuzzy matching, as an array in the rules' order.

    Words and joined texts are bound to lambda variables, so that each is made once a row however many rules ask for it.
    """
    words = F.filter(F.transform(F.coalesce(tokens, strings([])), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    bound = F.transform(F.array(words), lambda w: F.struct(w.alias("words"), F.array_join(w, " ").alias("spaced"), F.array_join(w, "").alias("joined")))
    return F.element_at(F.transform(bound, lambda b: _exact_topics(b["words"], b["spaced"], b["joined"], rules)), 1)


def _exact_topics(words: Column, spaced: Column, joined: Column, rules: TopicRules) -> Column:
    quoted = lambda terms: "|".join(re.escape(t) for t in terms)
    stated = lambda terms: joined.rlike(f"(?<![{''.join(rules.negations)}])(?:{quoted(terms)})" if rules.negations else f"(?:{quoted(terms)})")
    held = lambda term: F.contains(spaced, F.lit(term)) | F.contains(joined, F.lit(term))
    all_negatives = list(dict.fromkeys([*rules.negatives, *[n for t in rules.topics if t.anchors for n in t.negatives]]))
    negative = _any([F.contains(joined, F.lit(p)) for p in rules.good_bad])
    if all_negatives:
        negative |= stated(all_negatives)
    found = []
    for t in rules.topics:
        aware = [p for p in t.phrases if p in rules.negation_aware]
        weak = [p for p in t.phrases if p in rules.weak and p not in rules.negation_aware]
        plain = [p for p in t.phrases if p not in rules.weak and p not in rules.negation_aware]
        yes = _any(map(held, plain)) | (_any(map(held, weak)) & negative)
        if aware:
            yes |= stated(aware)
        if t.anchors and t.negatives:
            one, other = quoted(t.anchors), quoted(t.negatives)
            near = joined.rlike(f"(?:{one}).{{0,{t.char_gap}}}(?:{other})|(?:{other}).{{0,{t.char_gap}}}(?:{one})")
            by_word = _near_words(words, t)
            both = _any(map(held, t.anchors)) & _any(map(held, t.negatives))
            yes |= both & (by_word | near)
        found.append(F.when((F.size(words) > 0) & yes, F.lit(t.name)))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def topic_frequency(docs: DataFrame, topics: str) -> DataFrame:
    """topic, frequency: a document counts once for each of its topics."""
    return docs.select(F.explode(F.array_distinct(topics)).alias("topic")).filter("topic <> ''").groupBy("topic").agg(F.count(F.lit(1)).alias("frequency"))
