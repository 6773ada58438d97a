"""SimHash groups against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from sylvan.llm import simhash
from sylvan.session import Scratch


def slow_fingerprint(text, shingle=3):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps, distance):
    """fingerprint -> smallest fingerprint (signed) of its component."""
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = list(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    roots = {}
    for f in fps:
        roots[find(f)] = min(roots.get(find(f), 1 << 64), signed[f])
    return {signed[f]: roots[find(f)] for f in fps}


def test_masks_cover_every_pair_of_bits():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_fingerprints_match_plain_definition(spark, odd_docs, odd_rows):
    got = simhash.simhash_groups(odd_docs).select("doc_id", simhash.hex_fingerprint().alias("f")).collect()
    assert sorted((str(r["doc_id"]), r["f"]) for r in got) == sorted((str(i), f"{slow_fingerprint(t):016x}") for i, t in odd_rows)


def test_links_find_all_pairs_and_no_other(spark):
    rnd = random.Random(1)
    for distance in (1, 2):
        fps = set()
        for _ in range(40):
            f = rnd.getrandbits(64)
            fps.add(f)
            for _ in range(rnd.randrange(8)):  # chains and crowds around it
                f ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 4)))
                fps.add(f)
        want = slow_groups(fps, distance)
        nodes = spark.createDataFrame([(f,) for f in want], "fp long")
        with Scratch(spark, "test") as scratch:
            found = simhash.components(simhash.near_links(nodes, distance), scratch).collect()
        got = {r["node"]: r["root"] for r in found}
        assert {f: got.get(f, f) for f in want} == want


def test_many_near_copies_of_one_fingerprint(spark):
    near = [(1 << i | 1 << j) - (1 << 64 if i == 63 or j == 63 else 0) for i in range(64) for j in range(i)]
    nodes = spark.createDataFrame([(f,) for f in near], "fp long")
    links = simhash.near_links(nodes, 2)
    assert links.count() <= 65 * len(near)
    with Scratch(spark, "test") as scratch:
        assert simhash.components(links, scratch).select("root").distinct().count() == 1


def test_groups_and_kept_documents(spark, odd_docs):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(odd_docs).collect()}
    assert {(1, 1), (2, 1), (6, 1), (None, 1), (4, 4), (5, 4)} <= got  # no words: one group
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 4, 7, 8, 9] and ids.count(None) == 1


def test_empty_table(spark, no_docs):
    assert simhash.simhash_groups(no_docs).count() == 0
    assert simhash.keep_one(no_docs).columns == no_docs.columns


def test_query_against_brute_force(spark):
    from sylvan.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: slow_fingerprint(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    roots = slow_groups(set(docs.values()), 2)
    least = {}
    for i, f in docs.items():
        root = roots[signed(f)]
        least[root] = min(least.get(root, i), i)
    rows = queries.op1_simhash(spark, sf).agg(F.collect_list(F.struct("doc_id", "fingerprint", "component_id")).alias("x")).first()["x"]
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (i, f"{f:016x}", least[roots[signed(f)]]) for i, f in docs.items()
    }
