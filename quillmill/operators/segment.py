"""Segmentation of cleaned text into words: split at spaces, or a dictionary's likeliest path for CJK runs."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import keep_tokens
from .lexicon import protected_terms
from .values import DOMAIN_STOPWORDS, DRINKS, SEGMENTER_WORDS

_RUN = re.compile(r"[一-鿿]+|[^\s一-鿿]+")


def dictionary(dataset: str = "drinks", lines: Iterable[str] = ()) -> dict[str, int]:
    """Word weights: the built-in ones, the rules' words, and lines ``word weight kind``."""
    words = {w.lower(): n for w, n in SEGMENTER_WORDS.get(dataset, ())}
    for w in [*protected_terms(DRINKS), *DOMAIN_STOPWORDS.get(dataset, ())]:
        words.setdefault(w, 5)
    for line in lines:
        parts = line.split("#", 1)[0].split()
        if parts:
            words[parts[0].lower()] = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else 5
    return words


class Segmenter:
    """CJK runs take the path of words with the largest product of frequencies; unknown characters stand alone."""

    def __init__(self, words: Mapping[str, int]):
        total = sum(words.values()) + 1
        self.weight = {w: math.log(n / total) for w, n in words.items() if n > 0}
        self.unknown = math.log(0.5 / total)
        self.longest = max(map(len, self.weight), default=1)

    def run(self, text: str) -> list[str]:
        n = len(text)
        best: list[tuple[float, int]] = [(0.0, 0)] * (n + 1)
        for end in range(1, n + 1):
            best[end] = max(
                (best[s][0] + self.weight.get(text[s:end], self.unknown if end - s == 1 else -math.inf), s) for s in range(max(0, end - self.longest), end)
            )
        out, at = [], n
        while at:
            out.append(text[best[at][1] : at])
            at = best[at][1]
        return out[::-1]

    def __call__(self, text: str | None) -> list[str]:
        return [w for part in _RUN.findall(text or "") for w in (self.run(part) if "一" <= part[0] <= "鿿" else [part])]


def segmented(cleaned: Column, words: Mapping[str, int] | None = None, **options) -> Column:
    """Tokens of cleaned text by an Arrow UDF, then ``keep_tokens`` natively. jieba is used where it is installed."""
    words = dict(words) if words is not None else dictionary()

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            import jieba

            for w, n in words.items():
                jieba.add_word(w, n)
            segment = lambda t: [w for w in jieba.cut(t or "") if w.strip()]
        except ImportError:
            segment = Segmenter(words)
        for s in batches:
            yield s.map(segment)

    return keep_tokens(cut(cleaned), **options)
