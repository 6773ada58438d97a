"""SimHash near-duplicate groups by covering locality-sensitive hashing.

A document's fingerprint has 64 bits: a bit is 1 if it is set in more than
half of the XXH64 values of the document's word shingles. Documents link when
their fingerprints differ in at most ``max_distance`` bits; a group is a
connected component of links.

Finding the links (no false negatives, no pairs of one bucket):

1. Rows are first reduced to distinct fingerprints, so exact copies never meet.
2. Covering masks: each bit position gets a non-zero vector of
   GF(2)^(r+1) (r = ``max_distance``), in turn. The table of a non-zero v keeps
   the bits whose vector has an odd inner product with v. The vectors of any r
   positions lie in a proper subspace, so some v is orthogonal to all of them:
   in that table both fingerprints keep the same bits. For r = 2 that makes 7
   tables that keep 36 or 37 of the 64 bits.
3. A fingerprint that shares a bucket with another one is a candidate, on the
   bits that the shared tables drop. It emits itself and its flips of one such
   bit; for r = 2 two fingerprints are within the radius exactly if they share
   an emitted value (themselves, or the point half-way). At most 65
   fingerprints can lie around one value, so no group of that step is hot,
   however many near copies there are.
4. Components by alternating large-star and small-star rounds on distinct
   fingerprints, each round written to the shared folder.

Nulls and corner cases: a null text has no words; no words give fingerprint
zero, which links like any other; fewer words than the shingle length give one
shingle of the whole sequence. Repeated rows keep one result row each. Null
ids get a result row too; a component's id is the smallest non-null id in it
(null if there is none). Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import small_batches, texts_of
from sylvan.session import Scratch

BITS = 64
SEED = 42


def shingle_hashes(text: str, shingle: int) -> list[int]:
    """XXH64 of every word shingle of ``text``, repeats included."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return [digest(b" ".join(words), SEED)] if n else []
    joined = b" ".join(words)
    after = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1)
    first = np.concatenate(([0], after[: n - shingle]))
    last = after[shingle - 1 :] - 1
    return [digest(joined[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())]


def fingerprint(text: str, shingle: int) -> int:
    hashes = shingle_hashes(text, shingle)
    if not hashes:
        return 0
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(rows), 4096):
        counts += np.unpackbits(rows[at : at + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(rows), bitorder="little").view("<i8")[0])


def fingerprint_column(text: str, shingle: int) -> Column:
    """The fingerprint of a text column, as a signed 64-bit value."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts_of(texts)], dtype="int64")

    return simhash(F.col(text))


def covering_masks(radius: int) -> list[int]:
    """The kept bits of each table, as unsigned 64-bit masks."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        kept = [i for i in range(BITS) if ((1 + i % vectors) & v).bit_count() % 2]
        masks.append(sum(1 << i for i in kept))
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_links(fingerprints: DataFrame, max_distance: int) -> DataFrame:
    """Links (u, v), u > v, between distinct fingerprints (column ``fp``) whose
    components are those of all pairs within ``max_distance`` bits (1 or 2)."""
    if max_distance not in (1, 2):
        raise ValueError("max_distance must be 1 or 2")
    masks = covering_masks(max_distance)
    # the shuffled bits are the key; the table number keeps tables apart
    tables = F.array(*[
        F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
        for t, m in enumerate(masks)
    ])
    placed = fingerprints.select("fp", F.explode(tables).alias("b")).select("fp", "b.t", "b.bucket")
    # a bucket is worth a look if it holds two different fingerprints: min and
    # max are enough to know, and combine before the shuffle
    busy = (
        placed.groupBy("t", "bucket")
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("low <> high")
        .select("t", "bucket")
    )
    dropped = F.element_at(F.array(*[F.lit(_signed(~m & ((1 << 64) - 1))) for m in masks]), F.col("t").cast("int") + 1)
    candidates = (
        placed.join(busy, ["t", "bucket"])
        .groupBy("fp")
        .agg(F.bit_or(dropped).alias("dropped"))
    )
    flips = F.filter(
        F.transform(F.array(*[F.lit(_signed(1 << i)) for i in range(BITS)]), lambda bit: bit.bitwiseAND(F.col("dropped"))),
        lambda bit: bit != 0,
    )
    emitted = candidates.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)).alias("bit")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("point")
    )
    around = Window.partitionBy("point")  # at most 65 rows: the ball of radius 1
    low = F.min("fp").over(around)
    if max_distance == 1:  # the point itself must be one of the fingerprints
        emitted = emitted.withColumn("held", F.max((F.col("fp") == F.col("point")).cast("int")).over(around))
        emitted = emitted.withColumn("v", F.col("point")).where("held = 1 and fp <> point")
        return emitted.select(F.greatest("fp", "v").alias("u"), F.least("fp", "v").alias("v")).distinct()
    return emitted.select(F.col("fp").alias("u"), low.alias("v")).where("u <> v").distinct()


def _measure(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    ).first()
    return int(row[0]), int(row[1])


def components(links: DataFrame, scratch: Scratch, name: str = "links", max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v with u > v): alternating
    large-star and small-star until nothing changes. The root is the smallest
    node of the component."""
    current = scratch.save(links, f"{name}-0")
    before = _measure(current)
    for turn in range(1, max_rounds + 1):
        if before[0] == 0:
            break
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(below.select("u", F.col("m").alias("v"))).distinct()
        following = scratch.save(small, f"{name}-{turn}")
        now = _measure(following)
        scratch.drop(f"{name}-{turn - 1}")
        current = following
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_distance: int = 2,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: its id, ``fp`` (signed 64-bit fingerprint),
    ``root`` (the smallest fingerprint of its group), ``component_id`` (the
    smallest id of its group) and, under ``carried``, the columns named in
    ``carry``."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "simhash")
    extra = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    marked = scratch.save(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle).alias("fp"), *extra), "fingerprints"
    )
    nodes = scratch.save(marked.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    linked = components(near_links(nodes.select("fp"), max_distance), scratch)
    roots = nodes.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = roots.select("fp", "root").join(named, "root")
    kept = ["carried"] if carry else []
    return marked.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "root", "component_id", *kept)


def hex_fingerprint(fp: str = "fp") -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), BITS // 4, "0"))


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """One document of each group, with all its columns: the row whose id names
    the group (of several such rows, and of rows in a group without any id, the
    one whose text hashes lowest)."""
    grouped = simhash_groups(docs, id_col, text_col, shingle, max_distance, carry=docs.columns)
    named = grouped.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    first = named.groupBy("root").agg(F.min_by("carried", F.xxhash64(f"carried.{text_col}")).alias("carried"))
    return first.select("carried.*")
