"""BPE encoding and decoding of whole texts with a public vocabulary.

Method: a pair occurrence index. The distinct words of a part of a partition are laid end to end as symbols. Each pair of
neighbouring symbols that has a merge rank is listed with all its positions. Active ranks are taken in ascending order
from a heap: all occurrences of the pair are merged at once, and only the lists of the pairs that the merges made or
broke are changed (broken ones lazily, by checking a position before use). So the work follows the number of merges, not
the number of ranks times the text.

Words that recur are looked up: a worker keeps the tokens of at most ``MOST_WORDS`` words and those of one run. Beyond
that, and at a task's end, only words that were met again stay. That bounds memory and changes no result.

Texts become NFC, white space ends words, letters are lower-cased one by one, words are split by the vocabulary's
pattern, and special tokens are recognised in the raw text, as the tokenizers library does. A decoded text is the tokens'
names joined by spaces, since the vocabulary names no decoder; names are copied out of one buffer by array arithmetic.

Cases: a null text counts as empty and has no tokens; so do texts of white space. Texts of any length are encoded whole.
Repeated rows and ids are encoded row by row. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from .memory import give_back

#: Texts are encoded in runs of about so many characters (a longer text is a run of its own); words kept by a worker.
RUN_CHARS, MOST_WORDS = 1_000_000, 250_000

#: What ends a word: the characters with the Unicode property White_Space.
_SPACES = regex.compile("[\t-\r \x85\xa0  -     　]+")
#: ``str.split`` takes these for white space too, which they are not here.
_NOT_SPACES = "\x1c\x1d\x1e\x1f"
#: Below this character (Latin, Greek, Cyrillic) all libraries agree on letters, digits and case. Words with characters
#: from here on are normalised and split by the tokenizers library's own components, whose Unicode version decides.
_SETTLED = "\u0530"
#: Fixed value: the pattern that the vocabulary file names.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_names() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def split_words(text: str) -> list[str]:
    """The runs of a text without Unicode white space."""
    return [w for w in _SPACES.split(text) if w] if any(c in text for c in _NOT_SPACES) else text.split()


def _lower(text: str) -> str:
    """Lower case letter by letter: a final sigma is not a special case."""
    return text.replace("Σ", "σ").lower()


class Bpe:
    """A vocabulary file of the tokenizers library: byte-level BPE with a suffix at word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        parts = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not suffix or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or parts[0]["pattern"]["Regex"] != _PIECES:
            raise ValueError(f"{path}: not a word-end BPE vocabulary")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        names = [""] * self.size
        for name, i in [*vocab.items(), *self.special.items()]:
            names[i] = name
        spelled = [n.encode() + b" " for n in names]
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.name_size = np.array([len(n) for n in spelled], np.int64)
        self.name_start = np.cumsum(self.name_size) - self.name_size
        bytes_ = byte_names()
        self.inner = np.array([vocab[c] for c in bytes_], np.int64)
        self.last = np.array([vocab[c + suffix] for c in bytes_], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.pieces = regex.compile(_PIECES)
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.split = pre_tokenizers.Split(Regex(_PIECES), "removed", invert=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}  # in the order of their numbers
        self.ids, self.n_ids = np.zeros(1 << 16, np.int32), 0
        self.start, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.again = np.zeros(1 << 12, bool)  # met again in a later run

    def thin(self) -> None:
        """Keeps the words that were met again, of them the last half of ``MOST_WORDS``."""
        words, kept = list(self.words), np.flatnonzero(self.again[: len(self.words)])[-(MOST_WORDS // 2) :]
        start, count, ids = self.start[kept], self.count[kept], self.ids
        self.forget()
        ends = np.cumsum(count, dtype=np.int64)
        self.n_ids = int(ends[-1]) if len(ends) else 0
        self.ids = ids[np.repeat(start - ends + count, count) + np.arange(self.n_ids)]
        self.start, self.count, self.again = ends - count, count, np.zeros(len(kept), bool)
        self.words = {words[i]: k for k, i in enumerate(kept.tolist())}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of symbols, -1 without one."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, tokens a piece) of non-empty pieces, by the pair occurrence index."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        n = len(data)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            """Lists the pairs that begin at these positions."""
            rank = self.ranks(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            lo = 0
            for hi in [*cuts.tolist(), len(at)]:
                r = int(rank[lo])
                if r in index:
                    index[r].append(at[lo:hi])
                else:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(active, r)
                lo = hi

        add(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            nxt = after[at]
            good = alive[at] & (symbol[at] == a) & (nxt >= 0)
            good &= symbol[nxt] == b  # nxt is -1 only where good is false already
            at = at[good]
            if not len(at):
                continue
            if a == b:  # of a run of equal symbols, every second pair
                joined = np.concatenate([[False], after[at[:-1]] == at[1:]])
                begin = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - begin) % 2 == 0]
            gone = after[at]
            nxt = after[gone]
            symbol[at] = self.made[r]
            alive[gone] = False
            after[at] = nxt
            has = nxt >= 0
            before[nxt[has]] = at[has]
            prev = before[at]
            add(np.unique(np.concatenate([prev[prev >= 0], at[has]])))
        tokens = symbol[alive]
        total = np.concatenate([[0], np.cumsum(alive)])
        return tokens, np.diff(total[np.concatenate([[0], ends])])

    def learn(self, words: list[str]) -> None:
        """Encodes words not met before and keeps them."""
        pieces: dict[str, int] = {}
        parts: list[list[int]] = []  # pieces of each word; a special token as -1 - id
        for word in words:
            part = []
            for k, text in enumerate(self.cut.split(word) if "<|" in word else (word,)):
                if k % 2:
                    part.append(-1 - self.special[text])
                elif text.isascii():
                    part += [pieces.setdefault(p, len(pieces)) for p in self.pieces.findall(text.lower())]
                elif max(text) >= _SETTLED:
                    part += [pieces.setdefault(p, len(pieces)) for p, _ in self.split.pre_tokenize_str(self.normal.normalize_str(text))]
                else:
                    part += [pieces.setdefault(p, len(pieces)) for p in self.pieces.findall(_lower(unicodedata.normalize("NFC", text)))]
            parts.append(part)
        tokens, counts = self.merge([p.encode() for p in pieces]) if pieces else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        tokens, ends = tokens.tolist(), np.cumsum(counts).tolist()
        starts = [0, *ends[:-1]]
        lists = [[x for p in part for x in (tokens[starts[p] : ends[p]] if p >= 0 else (-1 - p,))] for part in parts]
        first, n = len(self.words), len(self.words) + len(words)
        flat = np.fromiter((x for t in lists for x in t), np.int32)
        if n > len(self.start):
            self.start, self.count, self.again = (np.concatenate([x, np.zeros(n // 2 + n - first, x.dtype)]) for x in (self.start, self.count, self.again))
        if self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) // 2 + len(flat), np.int32)])
        self.count[first:n] = [len(t) for t in lists]
        self.start[first:n] = self.n_ids + np.cumsum(self.count[first:n]) - self.count[first:n]
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.n_ids += len(flat)
        self.words.update(zip(words, range(first, n), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, tokens a text)."""
        split = [split_words(t) for t in texts]
        words = [w for t in split for w in t]
        n_words = np.array([len(t) for t in split], np.int64)
        if len(self.words) > MOST_WORDS:
            self.thin()
        at = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        self.again[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = list(dict.fromkeys(words[i] for i in new.tolist()))
            self.learn(unknown)
            at[new] = np.fromiter(map(self.words.__getitem__, (words[i] for i in new.tolist())), np.int64, len(new))
        count = self.count[at]
        ends = np.cumsum(count, dtype=np.int64)
        tokens = self.ids[np.repeat(self.start[at] - ends + count, count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        total = np.concatenate([[0], ends])
        bounds = np.concatenate([[0], np.cumsum(n_words)])
        return tokens, np.diff(total[bounds])

    def decode(self, tokens: np.ndarray, counts: np.ndarray) -> list[memoryview]:
        """The text of each of the lists of token ids, special ones included: ``counts`` ids a list, end to end."""
        size = self.name_size[tokens]
        ends = np.cumsum(size)
        out = self.spelling[np.repeat(self.name_start[tokens] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        view = memoryview(out)
        return [view[a : max(a, b - 1)] for a, b in zip(bounds, bounds[1:])]  # without the last space


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def text_runs(column: pa.Array):
    """(first row, texts) of about ``RUN_CHARS`` characters; null is empty."""
    row, run, size = 0, [], 0
    for i, text in enumerate(column):
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= RUN_CHARS:
            yield row, run
            row, run, size = i + 1, [], 0
    if run:
        yield row, run


def _task(path: str, work):
    """``work(bpe, batches)`` as a task; at its end the worker keeps the vocabulary and the words that recur."""

    def run(batches):
        bpe = load(path)
        try:
            yield from work(bpe, batches)
        finally:
            bpe.thin()
            give_back()

    return run


def _lists(tokens: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(tokens.astype(np.int32)))


def _encoded(bpe: Bpe, batches):
    for batch in batches:
        for row, texts in text_runs(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), _lists(*bpe.encode(texts))], names=["id", "ids"])


def _decoded(bpe: Bpe, batches):
    none = np.zeros(0, np.int64)
    for batch in batches:
        ids = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else none for x in batch.column(1)]
        texts = [bytes(bpe.decode(x, np.array([len(x)]))[0]) for x in ids]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "text"])


def _digested(with_ids: bool):
    def digest(bpe: Bpe, batches):
        for batch in batches:
            for row, texts in text_runs(batch.column(1)):
                tokens, counts = bpe.encode(texts)
                raw, ends = tokens.astype("<u4"), np.cumsum(counts)
                ids_sha = [hashlib.sha256(raw[e - c : e]).hexdigest() for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                text_sha = [hashlib.sha256(t).hexdigest() for t in bpe.decode(tokens, counts)]
                columns = {"id": batch.column(0).slice(row, len(texts)), "n_tokens": pa.array(counts), "ids_sha256": pa.array(ids_sha), "decoded_sha256": pa.array(text_sha)}
                if with_ids:
                    columns["ids"] = _lists(tokens, counts)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return digest


def _renamed(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(F.col("id").alias(id_col), *[c for c in df.columns if c != "id"])


def _narrow(docs: DataFrame, id_col: str, col: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col).alias("id"), F.col(col).alias("x")), docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) for every text."""
    narrow, kind = _narrow(docs, id_col, text_col)
    return _renamed(narrow.mapInArrow(_task(path or default_path(), _encoded), f"id {kind}, ids array<int>"), id_col)


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) for every list of ids; null gives an empty text."""
    narrow, kind = _narrow(encoded, id_col, ids_col)
    return _renamed(narrow.mapInArrow(_task(path or default_path(), _decoded), f"id {kind}, text string"), id_col)


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids): encodes and decodes every text in one pass."""
    narrow, kind = _narrow(docs, id_col, text_col)
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _renamed(narrow.mapInArrow(_task(path or default_path(), _digested(with_ids)), schema), id_col)


def op2_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
