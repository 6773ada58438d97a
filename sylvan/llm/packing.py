"""Packing documents into fixed-length sequences: shortest-pack-first over the
histogram of lengths.

A document of n tokens (with its end token) gives n // capacity full sequences
and one tail of n % capacity tokens. The tails are packed on their histogram
(at most ``capacity`` entries, whatever the corpus): lengths are placed longest
first, each into the packs that are filled least, new packs are opened only
where it fits nowhere. What is updated are counts of packing patterns, not
documents. Last, the emptiest packs are taken apart and their tails are cut to
fill the gaps of the others, so that little padding is left. The plan says, for each tail length and range of ranks, which sequence
and offset each of its pieces has; documents are joined to it by their rank
among the documents of the same tail length.

Ranks without a global sort: the tokenising task counts the lengths that it
has seen, writes each document's rank in its task, and the counts of all
(task, length) are summed up over the tasks per length. So no group holds more
rows than there are tasks, even if a third of the documents have one length.

Corner cases: a null or empty text is its end token alone; a text of any
length is cut whole; repeated rows are packed each on its own; an empty table
gives an empty result; null ids are kept. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import small_batches, texts_of
from sylvan.llm.tokens import CACHE_BYTES, encoder
from sylvan.session import Scratch

#: A gap shorter than this is left as padding: filling it would cost a cut for
#: a handful of tokens.
LEAST_GAP = 16
#: Rows of the plan for each token of the capacity, at most (before equal ranges
#: are put together).
PLAN_ROWS = 32


class Packs:
    """Open packs as runs of equal packs, by free space.

    A slot is (length, piece start, first rank): pack k of the run holds the
    piece of the tail of that length and rank first + k.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: dict[int, list[tuple[int, list[tuple]]]] = {}
        self.spaces: list[int] = []

    def add(self, free: int, count: int, slots: list[tuple]) -> None:
        if count <= 0:
            return
        if free not in self.runs:
            self.runs[free] = []
            insort(self.spaces, free)
        self.runs[free].append((count, slots))

    def count(self) -> int:
        return sum(count for runs in self.runs.values() for count, _ in runs)

    def slots(self) -> int:
        """Rows that the plan has now."""
        return sum(len(slots) for runs in self.runs.values() for _, slots in runs)

    def take(self, free: int) -> tuple[int, list[tuple]]:
        run = self.runs[free].pop()
        if not self.runs[free]:
            del self.runs[free]
            del self.spaces[bisect_left(self.spaces, free)]
        return run

    def place(self, tail: int, start: int, length: int, rank: int, count: int) -> None:
        """Place ``count`` pieces of ``length``, of the tails ``tail`` from
        ``rank`` on, each into the shortest pack, else into new ones."""
        while count:
            free = self.spaces[-1] if self.spaces else 0
            if free >= length:
                packs, slots = self.take(free)
                n = min(packs, count)
                self.add(free, packs - n, [(t, s, z, r + n) for t, s, z, r in slots])
                self.add(free - length, n, [*slots, (tail, start, length, rank)])
                rank, count = rank + n, count - n
                continue
            each = self.capacity // length
            packs = count // each
            if packs == 0:
                each, packs = count, 1
            slots = [(tail, start, length, rank + i * packs) for i in range(each)]
            self.add(self.capacity - each * length, packs, slots)
            rank, count = rank + each * packs, count - each * packs


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple]:
    """The plan for ``counts`` (tail length: documents): rows of (tail, start,
    length, first rank, last rank + 1, first sequence, offset).

    Its size depends on the capacity alone. Placing one length uses up runs of
    packs or splits the last one that it needs, so each length adds at most
    three runs, of at most ``capacity`` slots each. Filling gaps is held to
    ``PLAN_ROWS`` times the capacity; a plan that would grow beyond it keeps the
    gaps that are left then as padding."""
    packs = Packs(capacity)
    for tail in sorted(counts, reverse=True):
        packs.place(tail, 0, tail, 0, counts[tail])
    fill_gaps(packs, PLAN_ROWS * capacity)
    plan, sequence = [], 0
    for free in packs.spaces:
        for count, slots in packs.runs[free]:
            offset = 0
            for tail, start, length, rank in slots:
                plan.append((tail, start, length, rank, rank + count, sequence, offset))
                offset += length
            sequence += count
    return plan


def fill_gaps(packs: Packs, most_slots: int) -> None:
    """Take the emptiest packs apart and cut their pieces into the gaps of the
    others. A turn takes as many of a run of equal packs as all gaps have room
    for, the run's own gaps included, so the turns follow the runs, not the
    packs; it ends when less than a whole pack's room is left, when a turn no
    longer saves packs, or at ``most_slots`` slots in the plan."""
    capacity = packs.capacity
    while packs.spaces and packs.spaces[-1] >= LEAST_GAP:
        gaps = sum(free * count for free in packs.spaces if free >= LEAST_GAP for count, _ in packs.runs[free])
        n, slots, all_packs = gaps // capacity, packs.slots(), packs.count()
        if n == 0 or slots + capacity > most_slots:
            return
        donor = packs.spaces[-1]
        count, pieces = packs.take(donor)
        n = min(n, count)
        packs.add(donor, count - n, [(t, s, z, r + n) for t, s, z, r in pieces])
        for tail, start, length, rank in pieces:
            _pour(packs, tail, start, length, rank, n)
        if packs.count() >= all_packs:
            return


def _pour(packs: Packs, tail: int, start: int, length: int, rank: int, count: int) -> None:
    """Place pieces that may be cut: into the smallest gap that holds one
    whole, else cut to fill the largest gap."""
    todo = [(start, length, rank, count)]
    while todo:
        start, length, rank, count = todo.pop()
        at = bisect_left(packs.spaces, length)
        if at == len(packs.spaces) and (not packs.spaces or packs.spaces[-1] < LEAST_GAP):
            packs.add(packs.capacity - length, count, [(tail, start, length, rank)])
            continue
        free = packs.spaces[min(at, len(packs.spaces) - 1)]
        open_packs, slots = packs.take(free)
        n, part = min(open_packs, count), min(free, length)
        packs.add(free, open_packs - n, [(t, s, z, r + n) for t, s, z, r in slots])
        packs.add(free - part, n, [*slots, (tail, start, part, rank)])
        if length > part:
            todo.append((start + part, length - part, rank, n))
        if count > n:
            todo.append((start, length, rank + n, count - n))


def _tokenised(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int, capacity: int, word_cache: int) -> DataFrame:
    """Per document: key, ids (little-endian unsigned 32-bit, end id
    included), n, and its ranks in the task (``task``)."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        seen = [0] * capacity
        whole = 0
        for batch in batches:
            ids = [x + end for x in encoder(path, word_cache).encode(texts_of(batch["text"]))]
            rows = []
            for x in ids:
                n = len(x) // 4
                tail = n % capacity
                rows.append((n, tail, seen[tail], whole))
                seen[tail] += 1
                whole += n // capacity
            n, tail, rank, first = zip(*rows) if rows else ((),) * 4
            yield pd.DataFrame(
                {"key": batch["key"], "ids": ids, "n": n, "tail": tail, "rank": rank, "whole": first, "task": task}
            )

    key_type = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInPandas(
        work, f"key {key_type}, ids binary, n long, tail int, rank long, whole long, task int"
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    word_cache: int = CACHE_BYTES,
) -> DataFrame:
    """One row per piece: the document's id, ``start`` (its ids before the
    piece), ``length``, ``ids`` (the piece's ids as little-endian unsigned
    32-bit integers), ``doc_tokens``, ``sequence_id`` (from 0, gapless) and
    ``offset`` (in the sequence, gapless from 0). ``word_cache``: bytes of
    words that a Python worker holds while it tokenises."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "packing")
    tokens = scratch.save(_tokenised(docs, id_col, text_col, vocabulary, end_id, capacity, word_cache), "tokens")

    # documents per (task, tail) and full sequences per task, summed up over the tasks
    own = tokens.groupBy("task", "tail").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.floor(F.col("n") / capacity)).alias("whole"))
    own = scratch.save(own, "counts")
    before = Window.partitionBy("tail").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tails = own.select("task", "tail", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("tail_base"))
    by_task = own.groupBy("task").agg(F.sum("whole").alias("whole"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    fulls = by_task.select("task", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("whole_base"))

    # the histogram: at most ``capacity`` rows
    histogram = own.where("tail > 0").groupBy("tail").agg(F.sum("docs").alias("docs")).collect()
    plan = pack_lengths({r["tail"]: r["docs"] for r in histogram}, capacity)
    sequences = max((first + b - a for _, _, _, a, b, first, _ in plan), default=0)
    # every tail's ranges that have the same pieces: one row with all its pieces
    planned = spark.createDataFrame(_by_range(plan), "tail int, low long, high long, slots array<struct<start:int,length:int,sequence:long,offset:int>>")

    ranked = (
        tokens.join(tails.join(fulls, "task"), ["task", "tail"])
        .withColumn("rank", F.col("rank") + F.col("tail_base"))
        .withColumn("whole", F.col("whole") + F.col("whole_base"))
        .drop("tail_base", "whole_base", "task")
    )
    # the plan is bounded by the capacity alone (see pack_lengths), some 2 MB
    placed = ranked.join(
        F.broadcast(planned.withColumnRenamed("tail", "of_tail")),
        (F.col("tail") == F.col("of_tail")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
        "left",
    )
    n_whole = F.floor(F.col("n") / capacity)
    body = F.when(
        n_whole > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.greatest(n_whole, F.lit(1)) - 1),
            lambda i: F.struct(
                (i * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
                (F.lit(sequences) + F.col("whole") + i).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"))
    ends = F.transform(
        F.coalesce("slots", F.array().cast("array<struct<start:int,length:int,sequence:bigint,offset:int>>")),
        lambda s: F.struct(
            (n_whole * capacity + s["start"]).alias("start"), s["length"].cast("long").alias("length"),
            (s["sequence"] + F.col("rank") - F.col("low")).alias("sequence_id"), s["offset"].cast("long").alias("offset"),
        ),
    )
    pieces = F.transform(
        F.concat(body, ends),
        lambda p: F.struct(
            p["start"].alias("start"), p["length"].alias("length"),
            F.substring(F.col("ids"), (4 * p["start"] + 1).cast("int"), (4 * p["length"]).cast("int")).alias("ids"),
            p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"),
        ),
    )
    cut = placed.select(F.col("key").alias(id_col), F.col("n").alias("doc_tokens"), F.explode(pieces).alias("p"))
    return cut.select(id_col, "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def _by_range(plan: list[tuple]) -> list[tuple]:
    """Plan rows by tail and elementary rank range, with the pieces of each."""
    of_tail: dict[int, list[tuple]] = {}
    for tail, *rest in plan:
        of_tail.setdefault(tail, []).append(tuple(rest))
    rows = []
    for tail, parts in of_tail.items():
        edges = sorted({x for _, _, a, b, _, _ in parts for x in (a, b)})
        slots: dict[int, list[tuple]] = {low: [] for low in edges[:-1]}
        for start, length, a, b, first, offset in parts:
            for low in edges[bisect_left(edges, a) : bisect_left(edges, b)]:
                slots[low].append((start, length, first + low - a, offset))
        rows += [(tail, low, high, sorted(slots[low])) for low, high in zip(edges, edges[1:])]
    return rows


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    """Unsigned CRC32 of the ids' bytes."""
    return pd.Series([zlib.crc32(x) for x in ids], dtype="int64")
