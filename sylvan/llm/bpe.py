"""Byte-level BPE by prefix dynamic programming over a rank file.

For each prefix of a byte string there is exactly one last token in its BPE
encoding, and two neighbouring tokens of an encoding always encode, on their
own, to just these two. So the last token of a prefix is the one vocabulary
entry that ends there and may stand after the last token of the prefix before
it. ``Prefixes`` stores that token for every prefix: reading the encoding is a
walk back from the end, an append only adds entries, and an edit recomputes
entries until they agree with the old ones over the longest token's length,
from where on nothing can differ.

A text is cut by the vocabulary's pattern and each match is encoded
separately; a match that is itself a vocabulary entry is that token. Matches
seen before are looked up in a bounded cache.

Corner cases: a null or empty text has no ids (and decodes to no bytes); a
very long match costs time and memory in proportion to its length; rows are
independent, so repeated rows give equal results; an empty table gives an
empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm import tokens
from sylvan.llm.common import small_batches, texts_of

#: The pattern for which ``tokens.SPLIT`` is the same on ``tokens.PLAIN`` texts.
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Unicode white space, as the rank files' library has it in \s.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Matches held by one Python worker, and the longest match held (bytes).
CACHE_MATCHES = 500_000
LONGEST_HELD = 64


class Vocabulary:
    """Ranks of byte strings, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: b for b, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}

    def merged(self, text: bytes) -> list[bytes]:
        """BPE by its definition: merge the pair of lowest rank, leftmost
        first, until no pair is in the vocabulary. For single tokens and pairs."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(
                ((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None),
                default=None,
            )
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def is_whole(self, token: int) -> bool:
        """Whether the token's bytes encode to the token itself."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = len(self.merged(self.bytes_of[token])) == 1
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether both tokens' bytes together encode to these two tokens."""
        known = self._pairs.get((left, right))
        if known is None:
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.merged(a + b) == [a, b]
            if len(self._pairs) > 2_000_000:
                self._pairs.clear()
            self._pairs[left, right] = known
        return known


class Prefixes:
    """The last token of every prefix of a byte string (``last[n]`` of the
    first n + 1 bytes)."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.vocabulary = vocabulary
        self.text = b""
        self.last: list[int] = []
        self.append(text)

    def _last(self, text: bytes, last: list[int], end: int) -> int:
        vocab = self.vocabulary
        ranks, pairs = vocab.ranks, vocab._pairs
        for begin in range(max(0, end - vocab.longest), end):
            token = ranks.get(text[begin:end])
            if token is None:
                continue
            if begin == 0:
                if vocab.is_whole(token):
                    return token
                continue
            before = last[begin - 1]
            fits = pairs.get((before, token))
            if fits or fits is None and vocab.is_whole(token) and vocab.may_follow(before, token):
                return token
        raise ValueError("a byte is not in the vocabulary")

    def append(self, more: bytes) -> None:
        """Exact: entries of the old prefixes never change."""
        self.text += more
        for end in range(len(self.last) + 1, len(self.text) + 1):
            self.last.append(self._last(self.text, self.last, end))

    def edit(self, start: int, stop: int, by: bytes) -> int:
        """Replace bytes [start, stop); returns the number of entries computed."""
        text = self.text[:start] + by + self.text[stop:]
        last, shift, same = self.last[:start], len(by) - (stop - start), 0
        for end in range(start + 1, len(text) + 1):
            last.append(self._last(text, last, end))
            old = end - shift
            same = same + 1 if old > stop and self.last[old - 1] == last[-1] else 0
            if same >= self.vocabulary.longest and end - same >= start + len(by):
                last += self.last[old:]
                self.text, self.last = text, last
                return end - start
        self.text, self.last = text, last
        return len(text) - start

    def ids(self) -> list[int]:
        """The encoding: back from the end, token by token."""
        out, end = [], len(self.last)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class RankEncoder:
    """Encodes and decodes texts; ids are little-endian unsigned 32-bit."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
        self.plain = pattern == GPT_PATTERN
        self.held: dict[str, bytes] = {}
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token

    def match_ids(self, match: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(match)
        return [whole] if whole is not None else Prefixes(self.vocabulary, match).ids()

    def _learn(self, match: str) -> bytes:
        raw = match.encode("utf-8", "replace")
        ids = np.array(self.match_ids(raw), dtype="<u4").tobytes()
        if len(raw) <= LONGEST_HELD:
            if len(self.held) >= CACHE_MATCHES:
                self.held.clear()
            self.held[match] = ids
        return ids

    def encode(self, text: str) -> bytes:
        plain = self.plain and tokens.PLAIN.fullmatch(text) is not None
        cut = (tokens.SPLIT if plain else self.split).findall(text)
        try:
            return b"".join(map(self.held.__getitem__, cut))
        except KeyError:
            held = self.held
            return b"".join([held.get(m) or self._learn(m) for m in cut])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_encoders: dict[tuple[str, str], RankEncoder] = {}


def encoder(path: str, pattern: str) -> RankEncoder:
    """One encoder of a rank file per Python worker."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = RankEncoder(path, pattern)
    return _encoders[path, pattern]


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(ranks, pattern).encode
        for batch in batches:
            ids = [encode(t) for t in texts_of(batch["text"])]
            yield pd.DataFrame({"key": batch["key"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids})

    key = docs.select(id_col).schema[0].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInPandas(
        work, f"key {key}, n_tokens long, ids binary"
    )
    return out.withColumnRenamed("key", id_col)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded`` (bytes) added."""

    @F.pandas_udf("binary")
    def decoded(ids: pd.Series) -> pd.Series:
        decode = encoder(ranks, pattern).decode
        return pd.Series([decode(x) for x in ids], dtype=object)

    return encoded.withColumn("decoded", decoded(F.col(ids_col)))
