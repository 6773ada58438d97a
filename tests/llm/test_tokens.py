"""Tokenising, the binary token file and prefix BPE."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from sylvan.llm import bpe, tokenfile, tokens
from sylvan.session import Scratch

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    "", " ", "\n", "\n\n", " x", "x ", "x\n", "\nx", "a\nb c.\nD", "a  b", "a \n b", "\ta\r\nb", "don't 'S''s  \n\n x ",
    "<|endoftext|> hi", "\x1c\x1d a", "a\x85b\xa0c", "x²y ½ Ⅷ", "日本 語", "ªº 1２٣", "é é", "😀 👩‍👩‍👧", "!?" * 400,
    "a" * 3000, " " * 300 + "x", "oren, thon. (x) y;z", " a　b",
]


def alphabet_texts(seed, n=400):
    rnd = random.Random(seed)
    kinds = ["ab ", "the an\n", "éèà ü.,", "日本語한국어", "абвг ", "!?.,- ", "0123 ", "aeiou \n\t", "don't we'll "]
    for _ in range(n):
        kind = rnd.choice(kinds) + rnd.choice(["", " ", chr(rnd.randrange(32, 0x3000))])
        yield "".join(rnd.choice(kind) for _ in range(rnd.randrange(60)))


def test_word_cache_gives_the_librarys_ids():
    texts = ODD + list(alphabet_texts(1))
    library = Tokenizer.from_file(JSON)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    encoder = tokens.WordEncoder(JSON)
    assert encoder.encode(texts) == want
    assert encoder.encode(texts) == want  # from the cache
    assert max(map(len, encoder.held)) <= tokens.LONGEST_HELD


def test_words_of_a_batch_are_encoded_once():
    class Counted(tokens.Held):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    text = "the river 12, walks on\nby élan2 stones"
    encoder = tokens.WordEncoder(JSON)
    encoder.held = Counted(encoder.held.piece, encoder.marks)
    ids = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    assert encoder.encode([text] * 500) == [np.array(ids, dtype="<u4").tobytes()] * 500
    assert Counted.asked <= 20  # not once for each of 500 * 7 words


def test_stretches_of_letters_and_marks_give_the_librarys_ids():
    rnd = random.Random(5)
    parts = [*"abé×÷ªºµßɏÀÿ.,;:!?'-_19", "the", "'s", "élan", "ɏ", "x×", "÷y", "…", "«", "<|endoftext|", "q" * 70, "é" * 40]
    texts = ["".join(rnd.choice(parts) + rnd.choice(["", "", " ", "\n"]) for _ in range(rnd.randrange(30))) for _ in range(3000)]
    texts += ["", "x", ",", "x,", "é.", "é", " ", "\n", " x", "\nx", "x ", "x\n", "", " ,", ".\n"]
    library = Tokenizer.from_file(JSON)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    encoder = tokens.WordEncoder(JSON)
    assert sum(map(encoder._by_words, texts)) > 500
    assert encoder.encode(texts) == want
    assert encoder.encode(texts[::-1]) == want[::-1]
    assert [encoder.encode([t])[0] for t in texts] == want
    encoder.letters, encoder.held = None, tokens.Held(None, encoder.marks)  # merges not in the order of the ids
    assert encoder.encode(texts) == want


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000, 70_000])
def test_coder_round_trip(n):
    rnd = np.random.default_rng(n)
    for ids in (
        rnd.integers(0, 50257, n), np.minimum(rnd.zipf(1.2, n), 50256), np.zeros(n), np.tile([5, 6, 7, 50256], n // 4 + 1)[:n],
    ):
        ids = ids.astype(np.uint32)
        lanes, coded = tokenfile.encode_ids(ids, 50257)
        assert np.array_equal(tokenfile.decode_ids(coded, n, lanes, 50257), ids)


def test_coder_compresses_what_it_can_predict():
    ids = np.tile(np.arange(100, dtype=np.uint32), 2000)
    assert len(tokenfile.encode_ids(ids, 50257)[1]) < len(ids) / 4
    few = np.random.default_rng(1).integers(0, 16, 200_000).astype(np.uint32)
    assert len(tokenfile.encode_ids(few, 50257)[1]) < len(few) * 5.5 / 8  # not far above 4 bits


def test_block_checks():
    ids = [np.array(x, dtype="<u4").tobytes() for x in ([1, 2, 2], [], [9])]
    block = tokenfile.write_block([3, None, -4], ids, 10)
    keys, read = tokenfile.read_block(block)
    assert keys == [3, None, -4] and [x.tobytes() for x in read] == ids
    for at in (0, 8, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            tokenfile.read_block(bytes(broken))
    with pytest.raises(ValueError):
        tokenfile.write_block([1], [np.array([10], dtype="<u4").tobytes()], 10)


def slow_ids(text, end_id):
    return np.array(Tokenizer.from_file(JSON).encode(text or "", add_special_tokens=False).ids + [end_id], dtype="<u4")


def test_token_file(spark, odd_docs, odd_rows):
    with Scratch(spark, "test") as scratch:
        tokenfile.write_tokens(odd_docs, scratch.path("t"), JSON, end_id=2, alphabet=50257, block_ids=200)
        rows = tokenfile.read_tokens(spark, scratch.path("t")).orderBy("start").collect()
    assert len(rows) == len(odd_rows)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    want = sorted((str(i), slow_ids(t, 2).tobytes()) for i, t in odd_rows)
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in rows) == want


def test_token_file_of_nothing(spark, no_docs):
    with Scratch(spark, "test") as scratch:
        tokenfile.write_tokens(no_docs, scratch.path("t"), JSON, end_id=2, alphabet=50257)
        assert tokenfile.read_tokens(spark, scratch.path("t")).count() == 0


def test_op3_query(spark):
    from sylvan.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], slow_ids(r["text"], 2)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op3_tokenfile(spark, sf).collect()}
    at = 0
    for key, ids in docs:
        assert got[key] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_gives_the_librarys_ids(library):
    encoder = bpe.RankEncoder(RANKS, public_tokenizers.PATTERN)
    for text in ODD + list(alphabet_texts(2)):
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_prefixes_append_and_edit_are_exact(library):
    vocabulary = bpe.RankEncoder(RANKS, public_tokenizers.PATTERN).vocabulary
    rnd = random.Random(4)
    for _ in range(60):
        kind = rnd.choice([b"ab", b"the an", "éè".encode(), bytes(range(97, 123))])
        text = bytes(rnd.choice(kind) for _ in range(rnd.randrange(1, 200)))
        whole = bpe.Prefixes(vocabulary, text)
        parts = bpe.Prefixes(vocabulary)
        cut = rnd.randrange(len(text))
        parts.append(text[:cut])
        parts.append(text[cut:])
        assert parts.last == whole.last
        assert b"".join(vocabulary.bytes_of[t] for t in whole.ids()) == text
        a = rnd.randrange(len(text))
        b = rnd.randrange(a, len(text) + 1)
        by = bytes(rnd.choice(kind) for _ in range(rnd.randrange(4)))
        parts.edit(a, b, by)
        fresh = bpe.Prefixes(vocabulary, text[:a] + by + text[b:])
        assert parts.last == fresh.last and parts.text == fresh.text


def test_bpe_edit_recomputes_little():
    vocabulary = bpe.RankEncoder(RANKS, public_tokenizers.PATTERN).vocabulary
    prefixes = bpe.Prefixes(vocabulary, b"ababcadabra" * 400)
    assert prefixes.edit(2000, 2001, b"z") < 300


def test_bpe_documents(spark, odd_docs, odd_rows, no_docs, library):
    encoded = bpe.encode_documents(odd_docs, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((str(i), tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in odd_rows)
    assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4")), bytes(r["decoded"])) for r in rows) == want
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in rows)
    assert bpe.encode_documents(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_op10_query(spark, library):
    from sylvan.llm import queries

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op10_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.array(library.encode_ordinary(r["text"]), dtype="<u4")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert got[r["doc_id"]] == (len(ids), sha(ids.tobytes()), sha(r["text"].encode()))
