"""Ranked lexical search by presence-mask grouping.

Every item (a query) ranks all documents by an integer form of BM25. Documents
are worked on in blocks. In a block each term has a bitmap of the documents
that hold it. An item's bitmaps, laid side by side, give every document a mask:
which of the item's terms it holds. Documents with equal masks form a group. A
group's score cannot exceed the sum over its mask's terms of the highest
contribution that the term has in the block, so the groups are taken in
descending order of that maximum, and the item is finished in a block as soon as
the next maximum is below the score of its k-th best document so far, which a
task carries from block to block. A group that could tie is still evaluated.

On Spark: one pass cuts the texts into terms and keeps, for each document, its
number of terms and the places of those that any item asks for (written once);
the document frequencies are partial aggregates; a second pass over the written
rows does the groups in Arrow batches and hands on at most k documents of an
item per task, of which the k best are taken by a window whose first step runs
before the shuffle. No row per (item, document) is ever made, and a term that
stands in every document costs one bit in each.

Items are taken in turns of about ``TERMS_AT_ONCE`` distinct (item, term)
pairs, dealt by the hash of the id, so that what is shipped to the tasks (the
items of a turn and their terms' weights) is bounded whatever their number; a
single item counts whole.

Terms are the maximal runs of characters other than ASCII signs, spaces and
control characters; only A-Z is lower-cased. In UTF-8 all other characters are
bytes from 0x80 on, so a text is cut by one translation table on its bytes.

Corner cases: a null or empty text has no terms and counts neither in N nor in
L; each row is a document, so a repeated row counts and ranks again, next to
its equal; null ids are kept, after all others at equal scores; texts of one
item id are taken together, an equal row once; items without a term in any
document give no rows, and neither does an empty table; scores of 0 are left
out; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import arrow_rows
from sylvan.session import Scratch

#: Separators become spaces, A-Z small letters.
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Distinct (item, term) pairs of one turn, about.
TERMS_AT_ONCE = 100_000
#: Documents of a block, and documents of groups that are scored together.
BLOCK = 4096
SCORED_AT_ONCE = 64


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """The items of a turn, with their terms numbered."""

    def __init__(self, texts: dict):
        self.ids = list(texts)
        self.numbers: dict[bytes, int] = {}
        self.asked: list[dict[int, int]] = []  # term number -> times, of each item
        for found in texts.values():
            counted = Counter(t for text in found for t in terms_of(text))
            self.asked.append({self.numbers.setdefault(t, len(self.numbers)): n for t, n in counted.items()})


def _postings(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """Per document: ``key``, ``n`` (its terms) and, of the terms asked for,
    ``terms`` (numbers, ascending) and ``tf``."""
    numbers = items.numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(numbers)
        for batch in batches:
            found = [terms_of(t) for t in batch.column(1).to_pylist()]
            n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            get = numbers.get
            flat = np.fromiter((get(t, -1) for terms in found for t in terms), dtype=np.int64, count=int(n.sum()))
            known = flat >= 0
            place = np.repeat(np.arange(len(found)), n)[known] * size + flat[known]
            place, tf = np.unique(place, return_counts=True)
            edges = np.searchsorted(place, np.arange(len(found) + 1) * size).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(v.astype(t))) for v, t in ((place % max(size, 1), np.int32), (tf, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], ["key", "n", "terms", "tf"])

    key_type = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"key {key_type}, n long, terms array<int>, tf array<long>")


class Best:
    """The k best documents of an item: highest score first, equal scores by
    ascending id (null ids last)."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def add(self, scores: np.ndarray, keys: list) -> None:
        rows = self.rows + [(s, key) for s, key in zip(scores.tolist(), keys) if s > 0]
        self.rows = heapq.nsmallest(self.k, rows, key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))

    @property
    def least(self) -> int:
        """A document must score at least this to count."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1


def presence_masks(present: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents grouped by mask: the distinct masks (rows of bits, a column a
    term), the documents in group order, and where each group starts.
    ``present``: packed bitmaps, a row a term."""
    bits = np.unpackbits(present, axis=1, count=docs)
    masks = np.ascontiguousarray(np.packbits(bits, axis=0).T)
    keys = masks.reshape(docs, -1).view(np.dtype((np.void, masks.shape[1]))).reshape(docs)
    order = np.argsort(keys, kind="stable")
    edge = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
    distinct = np.unpackbits(masks[order[edge]], axis=1, count=present.shape[0])
    return distinct, order, edge


class Block:
    """A block of documents: bitmaps and contributions of the terms in it."""

    def __init__(self, n: np.ndarray, terms: np.ndarray, tf: np.ndarray, doc: np.ndarray, weights: np.ndarray, n_docs: int, total: int):
        m = 100 - 25 + (25 * n * n_docs) // total
        share = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        order = np.argsort(terms, kind="stable")  # documents stay in order
        self.docs = len(n)
        self.doc, self.share = doc[order], share[order]
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.edge = np.append(starts, len(terms))
        self.most = np.maximum.reduceat(self.share, starts) if len(terms) else np.zeros(0, dtype=np.int64)
        # packed bitmaps: the bits of one byte stand side by side
        width = -(-self.docs // 8)
        byte = np.repeat(np.arange(len(self.terms)), np.diff(self.edge)) * width + (self.doc >> 3)
        first = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])) if len(byte) else byte
        self.present = np.zeros((len(self.terms), width), dtype=np.uint8)
        if len(byte):
            self.present.reshape(-1)[byte[first]] = np.add.reduceat((128 >> (self.doc & 7)).astype(np.uint8), first)
        self.place = {t: i for i, t in enumerate(self.terms.tolist())}

    def scores(self, rows: list[int], times: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs`` (ascending) for the terms in ``rows``."""
        total = np.zeros(len(docs), dtype=np.int64)
        for row, n in zip(rows, times.tolist()):
            low, high = self.edge[row], self.edge[row + 1]
            at = low + np.searchsorted(self.doc[low:high], docs)
            held = at < high
            held[held] = self.doc[at[held]] == docs[held]
            total[held] += n * self.share[at[held]]
        return total

    def search(self, asked: dict[int, int], best: Best, keys: list) -> None:
        """Bring the item's best documents up to date with the block's."""
        rows = [self.place[t] for t in asked if t in self.place]
        if not rows:
            return
        times = np.array([n for t, n in asked.items() if t in self.place], dtype=np.int64)
        highest = times * self.most[rows]
        if highest.sum() < best.least:
            return
        masks, order, edge = presence_masks(self.present[rows], self.docs)
        most = masks @ highest
        ends = np.append(edge[1:], self.docs)
        turn = np.argsort(-most, kind="stable")
        at = 0
        while at < len(turn) and most[turn[at]] >= best.least:
            # groups next in line that may count, up to a bounded number of documents
            taken, held = [], 0
            while at < len(turn) and most[turn[at]] >= best.least and held < SCORED_AT_ONCE:
                group = order[edge[turn[at]] : ends[turn[at]]]
                taken.append(group)
                held += len(group)
                at += 1
            docs = np.sort(np.concatenate(taken))
            scores = self.scores(rows, times, docs)
            good = scores >= best.least
            best.add(scores[good], [keys[d] for d in docs[good].tolist()])


def _best_of_tasks(postings: DataFrame, items: Items, weights: np.ndarray, n_docs: int, total: int, k: int, item_type: str) -> DataFrame:
    ids, asked = items.ids, items.asked
    key_type = postings.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in ids]
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                block = Block(
                    part.column(1).to_numpy(), lists.flatten().to_numpy().astype(np.int64), part.column(3).flatten().to_numpy(),
                    np.repeat(np.arange(part.num_rows), sizes), weights, n_docs, total,
                )
                keys = part.column(0).to_pylist()
                for found, terms in zip(best, asked):
                    block.search(terms, found, keys)
        for item, found in zip(ids, best):
            if found.rows:
                rows = [(item, key, score) for score, key in found.rows]
                yield pa.RecordBatch.from_pylist([dict(zip(("item", "key", "score"), r)) for r in rows], schema)

    schema = pa.schema([("item", _arrow_type(item_type)), ("key", _arrow_type(key_type)), ("score", pa.int64())])
    return postings.select("key", "n", "terms", "tf").mapInArrow(work, f"item {item_type}, key {key_type}, score long")


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    scratch: Scratch | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    terms_at_once: int = TERMS_AT_ONCE,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item with a score above 0:
    (item, ``rank`` from 1, document id, ``score``), equal scores by ascending
    document id. Ids are bigint, int or string columns."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "lexical")
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("item is not null and text is not null").distinct()
    item_type = asked.schema["item"].dataType.simpleString()
    asked = scratch.save(asked, "items")
    size = asked.agg(F.sum(F.size(F.array_distinct(F.split("text", r"\s+"))))).first()[0] or 0
    turns = -(-size // terms_at_once) or 1
    found = []
    for turn in range(turns):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(turns)) == turn)
        texts: dict = {}
        for row in mine.sort("item", "text").collect():  # about terms_at_once terms
            texts.setdefault(row["item"], []).append(row["text"])
        batch = Items(texts)
        with arrow_rows(spark):
            postings = scratch.save(_postings(docs, batch, id_col, text_col), f"postings{turn}")
        totals = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not totals["docs"] or not batch.numbers:
            continue
        weights = np.zeros(len(batch.numbers), dtype=np.int64)
        for r in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            weights[r["t"]] = weight(totals["docs"], r["df"])
        found.append(_best_of_tasks(postings, batch, weights, totals["docs"], totals["terms"], k, item_type))
    if not found:
        key_type = docs.select(id_col).schema[0].dataType.simpleString()
        return spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} {key_type}, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("key").alias(id_col), "score")


def oracle_sql(k: int) -> str:
    """The same ranking in DuckDB SQL, term by term."""
    letters = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = rf"unnest(regexp_extract_all({letters}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""
    with words as (select doc_id, {cut} as term from documents),
    tf as (select doc_id, term, count(*) as tf from words group by all),
    sizes as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
    totals as (select count(*)::bigint as docs, sum(n)::bigint as terms from sizes),
    asked as (select item_id, term, count(*)::bigint as times from (select item_id, {cut} as term from benchmark) group by all),
    df as (select term, count(*)::bigint as df from tf where term in (select term from asked) group by term),
    shares as (
        select tf.doc_id, tf.term,
               floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint
               * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * n * docs) // totals.terms))) as share
        from tf join df using (term) join sizes using (doc_id), totals
    ),
    scores as (
        select item_id, doc_id, sum(times * share)::bigint as score from asked join shares using (term) group by item_id, doc_id
    )
    select item_id, rank::int as rank, doc_id, score
    from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
    where rank <= {k}
    """
