"""Fuzzy text ratios: the Indel ratio 2 LCS / (a + b), whole and over the windows of a longer text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.values import FUZZY_MIN_CHARS, FUZZY_RATIO


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


def _tidy(text: str | None) -> str:
    return (text or "").strip().lower()


def ratio(a: str | None, b: str | None) -> float:
    a, b = _tidy(a), _tidy(b)
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2 * common_length(a, b) / (len(a) + len(b))


def _windows(long: str, m: int) -> Iterator[str]:
    """All windows of length m, and the shorter ones at either end."""
    for i in range(len(long) - m + 1):
        yield long[i : i + m]
    for k in range(1, m):
        yield long[:k]
        yield long[-k:]


def partial_ratio(a: str | None, b: str | None) -> float:
    """The best ratio of the shorter text with a window of the longer; 1 if contained. Of equal lengths either may be cut."""
    a, b = sorted((_tidy(a), _tidy(b)), key=len)
    if not a:
        return 0.0
    if a in b:
        return 1.0
    best = max(ratio(w, a) for w in _windows(b, len(a)))
    return max(best, *(ratio(w, b) for w in _windows(a, len(b)))) if len(a) == len(b) else best


def reaches(a: str, b: str, least: float) -> bool:
    """Whether ``partial_ratio`` is at least ``least``, for tidy texts.

    A window's common subsequence is no longer than the number of its characters that the shorter text has at all. Those
    counts come from one prefix sum, and only windows that they allow are compared.
    """
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if not a:
        return False
    return a in b or _reaches(a, b, least) or (len(a) == len(b) and _reaches(b, a, least))


def _reaches(short: str, long: str, least: float) -> bool:
    m, own = len(short), set(short)
    need = lambda size: math.ceil(least * (size + m) / 2 - 1e-9)
    if len(long) <= 64:
        total = list(accumulate((c in own for c in long), initial=0))
        starts = [i for i in range(len(long) - m + 1) if total[i + m] - total[i] >= need(m)]
    else:
        codes, hit = np.frombuffer(long.encode("utf-32-le", "surrogatepass"), np.uint32), np.zeros(len(long), bool)
        for c in own:
            hit |= codes == ord(c)
        total = np.concatenate([[0], np.cumsum(hit)])
        starts = np.flatnonzero(total[m:] - total[:-m] >= need(m)).tolist()
    if any(common_length(long[i : i + m], short) >= need(m) for i in starts):
        return True
    for k in range(m - 1, 0, -1):
        if need(k) > k:
            return False
        if total[k] >= need(k) and common_length(long[:k], short) >= need(k):
            return True
        if total[-1] - total[-1 - k] >= need(k) and common_length(long[-k:], short) >= need(k):
            return True
    return False


def phrase_hit(hay: str, needle: str, least: float = FUZZY_RATIO, min_chars: int = FUZZY_MIN_CHARS) -> bool:
    h, n = _tidy(hay), _tidy(needle)
    if len(n) < min_chars or not h:
        return False
    return n in h or reaches(h, n, least)


@lru_cache(maxsize=1 << 18)
def word_hit(word: str, candidate: str, least: float = FUZZY_RATIO, min_chars: int = FUZZY_MIN_CHARS) -> bool:
    w, c = _tidy(word), _tidy(candidate)
    if not w or not c:
        return False
    if w == c:
        return True
    if len(w) < min_chars and len(c) < min_chars:
        return False
    # the shorter text bounds what two can have in common
    whole = 2 * min(len(w), len(c)) >= least * (len(w) + len(c)) and ratio(w, c) >= least
    return whole or reaches(w, c, least)


def ratio_column(a: Column, b: Column, partial: bool = False) -> Column:
    """The (partial) ratio of two text columns, by an Arrow UDF."""
    f = partial_ratio if partial else ratio

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([f(i, j) for i, j in zip(x, y, strict=True)], dtype=float)

    return run(a, b)
