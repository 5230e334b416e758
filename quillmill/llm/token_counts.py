"""Token counts under a unigram vocabulary: Viterbi that keeps a best score and a piece count, not the path.

Method: an Aho-Corasick automaton over the vocabulary lists all pieces that end at each character of a word, longest
first. Dynamic programming keeps, for each end, the best sum of scores and how many pieces it takes. Ties go as in the
tokenizers library's unigram model: a later candidate must be strictly better, and candidates for an end come in the
order of their starts, so the longest last piece wins. A character that no single-character piece matches may be taken
as unknown at the least score less 10; it then counts as its UTF-8 bytes (byte fallback). Scores are doubles.

The vocabulary is that of a SentencePiece model file: its pieces with the scores that it gives them. As there, a text is
led by U+2581 and every space becomes one; runs of them, line feeds, tabs and all other white space are counted like any
character, as pieces or as bytes. A text is cut where no piece can go across: before a run of U+2581, unless a piece has
one behind another character, and around line feeds and tabs, unless a piece has them. These parts are scored one by one
and a worker keeps the results of up to ``MOST_WORDS`` of them (a bound on memory that changes no result). Without
``whole`` the words alone count: texts are split at Unicode white space and each word is led by U+2581.

Cases: a null text counts as empty: no tokens, score 0. Texts of any length are counted whole. Repeated rows are counted row by row. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import split_words, text_runs

LEAD, UNKNOWN_PENALTY, MOST_WORDS = "▁", 10.0, 1_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """The (piece, score) of a SentencePiece file that are text: not its control, unknown, unused or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.IsControl, model.IsUnknown, model.IsUnused, model.IsByte)
    return [(model.IdToPiece(i), model.GetScore(i)) for i in range(model.GetPieceSize()) if not any(f(i) for f in special)]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]], whole: bool = False):
        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.whole, alone = whole, "".join(c for c in "\n\t" if not any(c in p for p, _ in vocabulary))
        lead = "" if any(LEAD in p.lstrip(LEAD) for p, _ in vocabulary) else LEAD
        rest = f"[^{lead}{alone}]" if lead or alone else r"[\s\S]"
        self.parts = re.compile("|".join([f"{lead}*{rest}+" if lead else f"{rest}+", *([f"{lead}+"] if lead else []), *([f"[{alone}]+"] if alone else [])]))
        self.known: dict[str, int] = {}
        self.counts, self.scores = np.zeros(1 << 12, np.int64), np.zeros(1 << 12)

    def count(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of a word, lead included."""
        n = len(word)
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        at = self.matches.iter(word)
        found = next(at, None)
        for end in range(n):
            top, least, single = None, 0, False
            while found and found[0] == end:
                size, score = found[1]
                score += best[end + 1 - size]
                if top is None or score > top:
                    top, least = score, pieces[end + 1 - size] + 1
                single = size == 1  # the shortest match comes last
                found = next(at, None)
            if not single:
                score = best[end] + self.unknown
                if top is None or score > top:
                    top, least = score, pieces[end] + len(word[end].encode("utf-8", "replace"))
            best[end + 1], pieces[end + 1] = top, least
        return pieces[n], best[n]

    def split(self, text: str) -> list[str]:
        """Parts, each with its lead, that no piece goes across."""
        if self.whole:
            return self.parts.findall(LEAD + text.replace(" ", LEAD)) if text else []
        return [LEAD + w for w in split_words(text)]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, scores) of whole texts."""
        split = [self.split(t) for t in texts]
        words = [w for t in split for w in t]
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            unknown = list(dict.fromkeys(words[i] for i in new))
            first, n = len(self.known), len(self.known) + len(unknown)
            if n > len(self.counts):
                self.counts, self.scores = np.resize(self.counts, 2 * n), np.resize(self.scores, 2 * n)
            for k, word in enumerate(unknown, first):
                self.counts[k], self.scores[k] = self.count(word)
            self.known.update(zip(unknown, range(first, n), strict=True))
            at[new] = [self.known[words[i]] for i in new]
        ends = np.cumsum([len(t) for t in split])
        sums = [np.concatenate([[0], np.cumsum(v[at])]) for v in (self.counts, self.scores)]
        starts = np.concatenate([[0], ends[:-1]]).astype(int)
        return tuple(s[ends] - s[starts] for s in sums)


_LOADED: dict[tuple[str, bool], Counter] = {}


def load(path: str, whole: bool = False) -> Counter:
    if (path, whole) not in _LOADED:
        _LOADED[path, whole] = Counter(read_vocabulary(path), whole)
    return _LOADED[path, whole]


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id_col, n_tokens, best_score) for every text: with its white space if ``whole``, else of its words."""
    path = path or default_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def counted(batches):
        counter = load(path, whole)
        for batch in batches:
            for row, texts in text_runs(batch.column(1)):
                counts, scores = counter.texts(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(counts), pa.array(scores)], names=["id", "n_tokens", "best_score"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = narrow.mapInArrow(counted, f"id {kind}, n_tokens long, best_score double")
    return out.select(F.col("id").alias(id_col), "n_tokens", "best_score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), whole=True)
