"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from sylvan.llm import spelling
from sylvan.session import Scratch

LOWER = {c: c + 32 for c in range(65, 91)}


def slow_words(docs, noise=97):
    counted = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counted[run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_forms(words):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 2 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


def got(spark, words):
    rows = spelling.spelling_forms(words, Scratch(spark, "spelling-test")).collect()
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows)


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abc"), (3, "aeñn"), (4, "abcdefgh")])
def test_near_words(spark, seed, letters):
    """Few letters: bigrams repeat inside a word and are equally frequent."""
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(5, 9))): rnd.choice([3, 4, 7, 8, 16, 40]) for _ in range(250)}
    assert got(spark, spark.createDataFrame(list(words.items()), "word string, n long")) == slow_forms(words)


def test_planted_edits(spark):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(5, 14))) for _ in range(60)]
    words = {w: 1000 for w in base}
    for w in base:
        for _ in range(6):
            i, c = rnd.randrange(len(w)), rnd.choice("abcxyzé")
            for v in (w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]):
                if len(v) >= 5:
                    words.setdefault(v, rnd.choice([3, 10, 400, 700]))
    assert got(spark, spark.createDataFrame(list(words.items()), "word string, n long")) == slow_forms(words)


def test_chain_of_forms(spark):
    """Forms lead on as long as the counts double."""
    words = {"aaaaa" + "b" * i: 3 * 2**i for i in range(14)}
    rows = got(spark, spark.createDataFrame(list(words.items()), "word string, n long"))
    assert rows == slow_forms(words) and {r[2] for r in rows} == {"aaaaa" + "b" * 13}


def test_words_of_documents(spark):
    rnd = random.Random(4)
    stems = ["Haus", "maison", "Straße", "école", "window", "windows", "forest", "Élève", "naïve", "river"]
    docs = [(i, " ".join(rnd.choice(stems) + rnd.choice(["", "s", "S,", "-x", "1"]) for _ in range(80))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for noise in (97, 3, None):
        want = slow_words(docs, noise)
        counted = spelling.count_words(frame, noise=noise)
        assert {r["word"]: r["n"] for r in counted.collect()} == want
    assert got(spark, spelling.count_words(frame, noise=3)) == slow_forms(slow_words(docs, 3))


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    assert got(spark, spelling.count_words(odd_docs, noise=97)) == slow_forms(slow_words(odd_rows))
    assert got(spark, spelling.count_words(no_docs, noise=97)) == []
    with pytest.raises(ValueError):
        spelling.count_words(odd_docs, least_chars=3)


def test_pivots_are_the_least_pair(spark):
    """The dynamic programme against all pairs."""
    from itertools import combinations

    from pyspark.sql import functions as F

    rnd = random.Random(8)
    rows = []
    for i in range(200):
        at = sorted(rnd.sample(range(1, 12), rnd.randrange(3, 9)))
        rows.append((i, [(a, rnd.randrange(1, 9)) for a in at]))
    frame = spark.createDataFrame(rows, "i long, g array<struct<at:int,df:long>>")
    for r in frame.withColumn("pair", spelling._least_pair(F.col("g"))).collect():
        best = min((x["df"] + y["df"], x["at"], y["at"]) for x, y in combinations(r["g"], 2) if y["at"] - x["at"] >= 2)
        assert tuple(r["pair"]) == best
