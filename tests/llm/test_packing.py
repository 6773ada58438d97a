"""Packing: every id in exactly one piece, sequences gapless and within capacity."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sylvan.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def slow_ids(text, end_id):
    library = Tokenizer.from_file(PATH)
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end_id], dtype="<u4")


@pytest.mark.parametrize("seed", range(6))
def test_plan_covers_every_rank(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([8, 64, 1024])
    kinds = [rnd.randrange(1, capacity) for _ in range(rnd.randrange(1, 40))]
    counts = {k: rnd.choice([1, 3, 50, 700]) for k in kinds}
    plan = packing.pack_lengths(counts, capacity)
    seen, sequences = defaultdict(Counter), defaultdict(list)
    for tail, start, length, low, high, first, offset in plan:
        for rank in range(low, high):
            seen[tail, rank].update(range(start, start + length))
            sequences[first + rank - low].append((offset, length))
    assert set(seen) == {(k, r) for k, n in counts.items() for r in range(n)}
    assert all(set(c) == set(range(k)) and max(c.values()) == 1 for (k, _), c in seen.items())
    assert set(sequences) == set(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(k * n for k, n in counts.items())
    # little padding: beyond the last sequences only gaps too short to cut for
    assert len(sequences) <= total / (capacity - min(packing.LEAST_GAP, capacity // 2)) + 2


def check(rows, docs, end_id, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, parts in pieces.items():
        texts = [t for i, t in docs if i == key]
        want = sorted(tuple(slow_ids(t, end_id)) for t in texts)
        if len(texts) == 1:
            ids, at = b"", 0
            for r in sorted(parts, key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(want[0]) and len(r["ids"]) == 4 * r["length"]
                at += r["length"]
                ids += bytes(r["ids"])
            assert tuple(np.frombuffer(ids, "<u4")) == want[0]
        else:
            assert sum(r["length"] for r in parts) == sum(map(len, want))
    assert {i for i, _ in docs} == set(pieces)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(sequences) == set(range(len(sequences)))


def test_odd_documents(spark, odd_docs, odd_rows):
    check(packing.pack_documents(odd_docs, PATH, capacity=256, end_id=7).collect(), odd_rows, 7, 256)


def test_empty_table(spark, no_docs):
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_query(spark):
    from sylvan.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: slow_ids(r["text"], 0) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op2_packing(spark, sf).collect()
    for r in rows:
        part = docs[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(docs[r["doc_id"]])
    assert sum(r["length"] for r in rows) == sum(map(len, docs.values()))
    used = len({r["sequence_id"] for r in rows}) * 1024
    assert sum(map(len, docs.values())) / used > 0.98


def test_plan_does_not_grow_with_the_documents():
    rng = np.random.default_rng(1)
    shape = np.bincount(np.exp(rng.normal(6.2, 1.1, size=200_000)).astype(int) % 1024, minlength=1024)[1:]
    for peak in (None, 300):  # with and without a length that a third of the documents have
        sizes = []
        for docs in (10**6, 10**9, 10**12):
            share = shape / shape.sum() if peak is None else shape / shape.sum() * 2 / 3 + (np.arange(1, 1024) == peak) / 3
            counts = {t + 1: int(n) for t, n in enumerate(share * docs) if n >= 1}
            plan = packing.pack_lengths(counts, 1024)
            tokens = sum(t * n for t, n in counts.items())
            sequences = max(first + b - a for _, _, _, a, b, first, _ in plan)
            assert sum(z * (b - a) for _, _, z, a, b, _, _ in plan) == tokens
            assert 0 <= 1 - tokens / sequences / 1024 < 0.01
            sizes.append(len(packing._by_range(plan)))
        assert max(sizes) < 1.2 * sizes[0] and max(sizes) < packing.PLAN_ROWS * 1024
