"""Ranked lexical search against a plain reading of the formula."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sylvan.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow(docs, items, k=20):
    cut = lambda t: [x.translate(LOWER) for x in TERM.findall(t or "")]
    held = [(i, cut(t)) for i, t in docs]
    held = [(i, Counter(t), len(t)) for i, t in held if t]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in sorted({r for r in items if None not in r}):
        asked.setdefault(item, Counter()).update(cut(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, tf, n in held:
            m = 75 + (25 * n * n_docs) // total
            s = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t, q in terms.items() if t in tf
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=str)


def corpus(rnd, docs, words):
    vocabulary = [f"w{i}" for i in range(words)]
    pick = lambda n: " ".join(vocabulary[min(int(rnd.expovariate(0.15)), words - 1)] for _ in range(n))
    return [(i, pick(rnd.randrange(1, 60))) for i in range(docs)], pick


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    docs, pick = corpus(rnd, 400, 120)
    docs += [(1000 + i, docs[0][1]) for i in range(60)]  # ties
    items = [(i, pick(rnd.randrange(1, 40))) for i in range(15)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").repartition(3)
    for at_once in (lexical.TERMS_AT_ONCE, 40):  # one turn, many turns
        found = lexical.search(frame(docs, "doc_id"), frame(items, "item_id"), terms_at_once=at_once)
        assert got(found) == slow(docs, items)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    items = [(1, "the House river0 THE 日本語 é"), (1, "the House river0 THE 日本語 é"), (1, "stone3"), (2, ""), (3, None), (None, "the"), (4, "?!"), (5, "zebra")]
    asked = spark.createDataFrame([(*r, "?", "?") for r in items], "item_id long, text string, score string, rank string")
    assert got(lexical.search(odd_docs, asked)) == slow(odd_rows, items)
    assert lexical.search(no_docs, asked).count() == 0
    assert lexical.search(odd_docs, asked.where("false")).count() == 0


def test_more_terms_than_a_word_has_bits(spark):
    rnd = random.Random(5)
    docs, pick = corpus(rnd, 150, 400)
    items = [(0, " ".join(f"w{i}" for i in range(300))), (1, " ".join(f"W{i % 70}" for i in range(140)))]
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=7)
    assert got(found) == slow(docs, items, 7)


def test_masks():
    rnd = np.random.default_rng(3)
    bits = rnd.integers(0, 2, (11, 70)).astype(np.uint8)
    masks, order, edge = lexical.presence_masks(np.packbits(bits, axis=1), 70)
    ends = np.append(edge[1:], 70)
    assert sorted(order.tolist()) == list(range(70)) and len({m.tobytes() for m in masks}) == len(masks)
    for mask, a, b in zip(masks, edge, ends):
        assert all((bits[:, d] == mask).all() for d in order[a:b])


def test_groups_beyond_the_bound_are_not_scored(monkeypatch):
    """The search stops early, and still finds the best."""
    n, terms = 2000, 6
    rnd = np.random.default_rng(1)
    tf = rnd.integers(0, 3, (n, terms)) * (rnd.random((n, terms)) < [0.9, 0.8, 0.5, 0.2, 0.05, 0.02])
    doc, term = np.nonzero(tf)
    weights = np.array([10, 50, 300, 900, 3000, 4000])
    block = lexical.Block(tf.sum(1) + 1, term, tf[doc, term], doc, weights, n, int(tf.sum() + n))
    scored = []
    scores = block.scores
    monkeypatch.setattr(block, "scores", lambda rows, times, docs: scored.extend(docs) or scores(rows, times, docs))
    best = lexical.Best(20)
    block.search({t: 1 for t in range(terms)}, best, list(range(n)))
    every = scores([block.place[t] for t in range(terms)], np.ones(terms, dtype=np.int64), np.arange(n))
    assert best.rows == sorted(((int(s), d) for d, s in enumerate(every)), key=lambda r: (-r[0], r[1]))[:20]
    assert len(scored) < n / 4
