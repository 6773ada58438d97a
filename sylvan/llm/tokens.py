"""Token ids of texts by a public byte-level BPE vocabulary of the tokenizers
library, a batch of texts at a time.

The library's own result is reproduced, not approximated. Its split pattern
never joins what stands before a single space or line feed with what stands
after it, nor a letter with a mark behind it. So where a text has no other white
space and no two such characters in a row, the stretches that these open have
the same ids wherever they stand. Texts are cut at all of them and their ids put
together by Arrow, and each distinct stretch of a batch is encoded once.

A stretch of letters with a space or line feed before it is a match of the
pattern by itself: all those of a batch are merged in one call by tiktoken, from
the vocabulary's own merges, whose order is checked to be that of its ids. Other
stretches are looked up in a bounded cache; new ones are encoded by the library,
and so is, whole, any other text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken

# The split pattern of these vocabularies; [^\W\d_] and \d stand for \p{L} and
# \p{N}, the same on the characters that PLAIN admits.
SPLIT = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
PLAIN = re.compile("[\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞]*")
# characters of which only space and line feed are white space
WORDS = re.compile("[\n -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞]*")

MARKS = ".,;:!?"
# bytes that are no part of a letter of WORDS in UTF-8 (those with the lead byte
# C2 are left out); \xd7 and \xf7 are seen by their second bytes
ODD = np.ones(256, dtype=bool)
ODD[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = False
IS_MARK = np.zeros(256, dtype=bool)
IS_MARK[list(MARKS.encode())] = True

#: Bytes that the words held by one Python worker take, about: those in use and
#: those of the generation before, each up to half.
CACHE_BYTES = 160_000_000
#: What a word takes beside its characters and ids: two objects and their place.
WORD_BYTES = 190
#: Longer words are not kept.
LONGEST_HELD = 64
#: Characters whose words are looked up together, and words encoded together by the library.
AT_ONCE = 8_000_000
WORDS_AT_ONCE = 2_000

_held: dict[str, WordEncoder] = {}


class Held(dict):
    """Word, with the space or line feed before it -> its ids (bytes). A word of
    the generation before comes back when it is met, so the frequent ones are
    never learned twice; of those not seen yet, words of letters are merged at
    once, others get an empty value, to be filled before the batch is put
    together."""

    def __init__(self, piece: Callable[[str], bytes] | None, marks: dict[str, bytes], before: dict | None = None):
        self.piece, self.marks = piece, marks
        self.before = before or {}
        self.new: list[str] = []
        self.bytes = 0

    def _letters(self, word: str) -> bytes | None:
        """The ids of a stretch of letters, a space or line feed before them."""
        if word.isalpha() or word[0] == " " and word[1:].isalpha():
            return self.piece(word)
        if word[0] == "\n" and word[1:].isalpha():
            return self.marks["\n"] + self.piece(word[1:])
        return None

    def __missing__(self, word: str) -> bytes | bytearray:
        value = self.before.get(word)
        if value is None and self.piece is not None:
            value = self._letters(word)
            if value is None and word[-1] in MARKS and (word[:-1].isalpha() or word[0] in " \n" and word[1:-1].isalpha()):
                value = self[word[:-1]] + self.marks[word[-1]]
        if value is None:
            value = bytearray()
            self.new.append(word)
        elif len(word) > LONGEST_HELD:
            return value
        self[word] = value
        self.bytes += WORD_BYTES + len(word) + len(value)
        return value


def letter_encoder(library) -> tiktoken.Encoding | None:
    """Merges each stretch that a space opens, and each line feed, by the
    library's merges; None if their order isn't that of the ids, by which
    tiktoken merges."""
    model = json.loads(library.to_str())["model"]
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in merges]
    # a byte is written as itself where it can be printed, else from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letter = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    if any(x >= y for x, y in zip(made, made[1:])) or not all(c in vocabulary for c in letter):
        return None
    ranks = {bytes(map(letter.__getitem__, t)): vocabulary[t] for t in [*letter, *(a + b for a, b in merges)]}
    # without a special token tiktoken would look for an empty one
    return tiktoken.Encoding("letters", pat_str=r"\n| ?[^ \n]+", mergeable_ranks=ranks, special_tokens={"\0": max(ranks.values()) + 1})


def _with_runs(raw: list[bytes]) -> list[int]:
    """Which texts have white space behind white space. (A text's ends count as
    white space for the pattern: a line feed there is not alone.)"""
    letters = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.cumsum(np.array(list(map(len, raw)), dtype=np.int64))
    white = (letters == 32) | (letters == 10)
    at = np.flatnonzero(white[:-1] & white[1:])
    text = np.searchsorted(ends, at, side="right")
    return np.unique(text[at + 1 < ends[text]]).tolist()


def _times(lead: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where two bytes are \xd7 or \xf7."""
    return (lead == 0xC3) & ((last == 0x97) | (last == 0xB7))


def _stretches(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Where stretches begin in joined texts: at a space or line feed, at a mark
    behind a letter and at the start of a text."""
    letters = np.frombuffer(data, dtype=np.uint8)
    opens = (letters == 32) | (letters == 10)
    marks = np.flatnonzero(IS_MARK[letters])
    marks = marks[marks > 1]
    last, lead = letters[marks - 1], letters[marks - 2]
    accented = (lead >= 0xC3) & (lead <= 0xC9) & (last >= 0x80) & ~_times(lead, last)
    opens[marks[accented | (last < 0x80) & ~ODD[last]]] = True
    starts = np.append(0, ends[:-1])
    opens[starts[starts < ends]] = True
    return np.flatnonzero(opens)


def _parts(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and bytes of an array of strings."""
    _, edges, data = words.buffers()
    edges = np.frombuffer(edges, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    return edges - edges[0], np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]]


def _of_letters(words: pa.LargeStringArray) -> np.ndarray:
    """Which words are a space or line feed and then letters only; long ones
    are left out."""
    edges, data = _parts(words)
    begins, sizes = edges[:-1], np.diff(edges)
    odd = ODD[data]
    odd[1:] |= _times(data[:-1], data[1:])
    opened = (data[begins] == 32) | (data[begins] == 10)
    odd[begins] = False
    return opened & (sizes > 1) & (sizes <= LONGEST_HELD) & ~np.logical_or.reduceat(odd, begins)


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids (as bytes)."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.cache_bytes = cache_bytes
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # bytes of each id: the vocabulary writes a byte as one character
        tokens = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.marks = {m: self._ids(m).tobytes() for m in (*MARKS, "\n")}
        self.letters = letter_encoder(self.library)
        self.held = Held(self.letters and self._piece, self.marks)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _piece(self, piece: str) -> bytes:
        return array("I", self.letters._core_bpe.encode_single_piece(piece.encode())).tobytes()

    def _by_words(self, text: str) -> bool:
        return WORDS.fullmatch(text) is not None and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        batch: list[str] = []
        size = 0
        for at, text in enumerate(texts):
            batch.append(text)
            size += len(text)
            if size > AT_ONCE or at == len(texts) - 1:
                out += self._encode(batch)
                batch, size = [], 0
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        raw = [t.encode() if self._by_words(t) else None for t in texts]
        for k in _with_runs([t or b"" for t in raw]):
            raw[k] = None
        ids = self._joined([t or b"" for t in raw])
        return [self._ids(text).tobytes() if t is None else x for text, t, x in zip(texts, raw, ids)]

    def _joined(self, raw: list[bytes]) -> list[bytes]:
        """The ids of texts that are cut into stretches, each encoded once."""
        data = b"".join(raw)
        if not data:
            return [b""] * len(raw)
        ends = np.cumsum(np.array(list(map(len, raw)), dtype=np.int64))
        begins = _stretches(data, ends)
        edges = np.append(begins, len(data)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(edges), pa.py_buffer(data)).dictionary_encode()
        distinct = words.dictionary
        plain = _of_letters(distinct) if self.letters else np.zeros(len(distinct), dtype=bool)
        others = distinct.filter(pa.array(~plain)).to_numpy(zero_copy_only=False)
        ids = list(map(self.held.__getitem__, others))
        self._learn()
        # the ids of the distinct words: those of letters, then the others
        encoded = pa.concat_arrays([self._merged(distinct.filter(pa.array(plain))), pa.array(ids, pa.large_binary())])
        place = np.where(plain, np.cumsum(plain) - 1, plain.sum() + np.cumsum(~plain) - 1)
        placed = encoded.take(pa.array(place[words.indices.to_numpy()]))
        _, edges, body = placed.buffers()
        # where the ids of the first stretch behind each text start
        cuts = np.frombuffer(edges, dtype=np.int64)[np.searchsorted(begins, ends)].tolist()
        body = memoryview(body)
        return [bytes(body[a:b]) for a, b in zip([0, *cuts], cuts)]

    def _merged(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of words of letters, each opened by a space or line feed."""
        if not len(words):
            return pa.array([], pa.large_binary())
        edges, data = _parts(words)
        ids = self.letters.encode_to_numpy(data.tobytes().decode(), disallowed_special=()).astype("<u4")
        at = 4 * np.searchsorted(np.cumsum(self.sizes[ids]), edges[1:]) + 4
        offsets = np.append(0, at).astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])

    def _learn(self) -> None:
        """Encode the words not seen yet: given to the library as running text,
        which it cuts between them, and taken apart by their bytes."""
        held, new = self.held, self.held.new
        held.new = []
        alone = [w for w in new if w in (" ", "\n") or w[0] not in " \n"]
        words = [w for w in new if w not in (" ", "\n") and w[0] in " \n"]
        for word in alone:
            self._fill(word, self._ids(word).tobytes())
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            ids = self._ids("".join(some))
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w.encode()) for w in some])) + 1
            raw, last = ids.tobytes(), 0
            for word, end in zip(some, (4 * ends).tolist()):
                self._fill(word, raw[last:end])
                last = end
        for word in [w for w in new if len(w) > LONGEST_HELD]:
            del held[word]  # the batch still has its value
        if held.bytes > self.cache_bytes // 2:
            held.before = {}  # what has not been met in a whole generation goes
            self.held = Held(held.piece, self.marks, held)

    def _fill(self, word: str, ids: bytes) -> None:
        self.held[word] += ids  # for the batch that has met it
        self.held[word] = bytes(ids)
        self.held.bytes += len(ids)


def encoder(path: str, cache_bytes: int = CACHE_BYTES) -> WordEncoder:
    """The encoder of a vocabulary file, one per Python worker, with room for
    ``cache_bytes`` of words from now on."""
    if path not in _held:
        _held[path] = WordEncoder(path)
    _held[path].cache_bytes = cache_bytes
    return _held[path]
