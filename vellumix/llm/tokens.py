"""Token ids of texts by a public byte-level BPE, over a trie of distinct words (problem 8)."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The split of a text into words that the public tokenizer's publication gives.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS_KEPT = 200_000


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Path of a vocabulary file: in ``folder``, else $PUBLIC_TOKENIZERS, else the installed package, else /opt/tokenizers."""
    spec = importlib.util.find_spec("public_tokenizers")
    found = [folder, os.environ.get("PUBLIC_TOKENIZERS"), *((spec.submodule_search_locations or []) if spec else []), "/opt/tokenizers"]
    return next(p for f in found if f and os.path.exists(p := os.path.join(f, name)))


class TrieEncoder:
    """Byte-pair encoding of words by the last token of each of their prefixes.

    The encoding of a prefix is that of a shorter prefix followed by one token, and a sequence of tokens is an encoding
    just if each adjacent pair is one by itself. So a trie node (a prefix) needs only its last token: the one token
    ending there that is compatible with the last token of the node where it starts. Prefixes that words share are
    computed once; a word's ids are read off by walking back.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        # Tokens as a trie from the last byte to the first: the tokens that end at a node are found by walking up.
        self.suffixes: dict = {}
        for b, i in self.ranks.items():
            at = self.suffixes
            for c in reversed(b):
                at = at.setdefault(c, {})
            at[-1] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}
        self.split = regex.compile(PATTERN).findall

    def merge(self, word: bytes) -> list[int]:
        """Plain byte-pair merging, for pairs of tokens only."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        key = (a, b)
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.pairs[key] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.pairs) > 4_000_000:
                self.pairs.clear()
        return ok

    def encode_words(self, words: list[str]) -> None:
        """Adds the encodings of distinct words to ``words``."""
        raw = sorted((w.encode("utf-8", "surrogatepass"), w) for w in words)
        # In byte order the trie's depth-first walk is a stack: the common prefix with the word before stays.
        before, last = b"", [(-1, 0)]  # per prefix length: last token and the length of the prefix before it
        for b, w in raw:
            keep = len(os.path.commonprefix([before, b]))
            del last[keep + 1 :]
            for end in range(keep + 1, len(b) + 1):
                at, found, n = self.suffixes, None, 0
                while n < end:
                    at = at.get(b[end - 1 - n])
                    if at is None:
                        break
                    n += 1
                    t = at.get(-1)
                    if t is not None and (n == end or self.compatible(last[end - n][0], t)):
                        if n < end or self.whole(t):
                            found = (t, end - n)
                            break
                last.append(found or (self.ranks[b[end - 1 : end]], end - 1))
            before = b
            ids, end = [], len(b)
            while end:
                t, end = last[end]
                ids.append(t)
            self.words[w] = ids[::-1]

    def whole(self, t: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        key = (t, -1)
        if key not in self.pairs:
            self.pairs[key] = self.merge(self.bytes_of[t]) == [t]
        return self.pairs[key]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, exactly as it stands; none for a null or empty text."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        new = {w for ws in split for w in ws if w not in self.words}
        if new:
            self.encode_words(list(new))
        known = self.words
        return [[i for w in ws for i in known[w]] for ws in split]


_ENCODERS: dict[str, TrieEncoder] = {}


def _encoder(path: str) -> TrieEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def _runs(texts: pd.Series, size: int = 1 << 20) -> Iterator[list]:
    """Consecutive texts of about ``size`` characters together, so that a batch's words stay in bounds."""
    out, n = [], 0
    for t in texts:
        t = t if isinstance(t, str) else None
        out.append(t)
        n += len(t or "")
        if n > size:
            yield out
            out, n = [], 0
    if out:
        yield out


def token_ids(text: Column, path: str | None = None) -> Column:
    """ARRAY<INT> of a text's ids without special tokens; an empty list for null and empty texts. Arrow batches, no shuffle."""
    file = path or tokenizer_file()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(file)
        for s in batches:
            yield pd.Series([x for run in _runs(s) for x in enc.encode(run)], dtype=object)

    return ids(text)


def token_counts(text: Column, path: str | None = None) -> Column:
    """INT number of ids of a text, 0 for null and empty ones; the ids never leave the worker."""
    file = path or tokenizer_file()

    @F.pandas_udf(T.IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(file)
        for s in batches:
            yield pd.Series([len(x) for run in _runs(s) for x in enc.encode(run)], dtype="int32")

    return count(text)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids) of every row, repeated rows as often as they stand; further columns are left out."""
    return df.select(id_col, token_ids(F.col(text_col), path).alias("ids"))
