"""Token ids in binary blocks: an adaptive context-mixing range coder.

A block holds the ids of whole documents. It is cut into lanes of equal
length, each with its own range coder; numpy codes one id of every lane at a
time. All lanes of a block share one model, which starts afresh in each block
and learns after every step from the ids that all lanes have just coded, so
encoder and decoder see the same model.

The model mixes three predictions of the next id:

- order 2: the id that lately followed the last two ids (hashed), with a
  confidence of 0 to 3 that grows with hits and falls with misses;
- order 1: the same after the last id;
- order 0: the frequencies of all ids in the block so far.

The interval of a lane is shared out between the three by weights. There is a
set of weights for each pair of confidences (and whether both predict the same
id); it is learned from how often each prediction was the one that hit. An id
that neither order 2 nor order 1 predicts is coded in the part of order 0 by
its frequency.

The range coder has a 64-bit low and range and emits 32-bit words: when a range
falls below 2^32 it is cut at the next multiple of 2^32, if it crosses one, so
no carry ever reaches a word that is out.

Block: ``SYTB``, version, flags, counts, then zlib-packed document ids and
lengths, lane sizes and the lanes' words; last a CRC32 of everything before.
Each block can be read without any other; a damaged one is an error.

Corner cases: an empty text is its end token; a document is never split (a
block with a very long document is that much larger); null document ids are
kept (first in the order); rows with the same id are ordered by their text's
hash; an empty table gives no block and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvan.llm.common import small_batches, texts_of
from sylvan.llm.tokens import AT_ONCE, encoder

MAGIC = b"SYTB"
VERSION = 1
HEAD = struct.Struct("<4sBBHIIIII")  # magic, version, flags, reserved, docs, ids, alphabet, lanes, size of meta

#: Ids in a block (whole documents: the first size reached), lanes at most, and
#: ids in a lane at least.
BLOCK_IDS = 1 << 20
MOST_LANES = 4096
LANE_IDS = 256

SHARE_BITS = 12  # precision of the mixing weights
ORDER2_BITS = 18  # hashed contexts of order 2
_WORD = np.uint64(32)
_LEAST = np.uint64(1 << 32)
_MASK = np.uint64((1 << 32) - 1)
_ALL = np.uint64((1 << 64) - 1)


class Model:
    """Predictions and weights, the same in the encoder and the decoder."""

    def __init__(self, alphabet: int, lanes: int):
        self.alphabet = alphabet
        self.bits = max(16, int(alphabet - 1).bit_length() + 1)  # of order-0 frequencies
        # entries: predicted id * 4 + confidence
        self.after1 = np.zeros(1 << max(1, int(alphabet - 1).bit_length()), dtype=np.uint32)
        self.after2 = np.zeros(1 << ORDER2_BITS, dtype=np.uint32)
        self.counts = np.zeros(alphabet, dtype=np.int64)
        self.hits = np.ones((32, 3), dtype=np.float64)  # context -> order 2, order 1, order 0
        self.hits[:, 2] = 4
        self.last1 = np.zeros(lanes, dtype=np.uint32)
        self.last2 = np.zeros(lanes, dtype=np.uint32)
        self.seen, self.due, self.turn = 0, 1, 0
        self.pending: list[np.ndarray] = []
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        total = 1 << self.bits
        if self.pending:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=self.alphabet)
        self.pending = []
        spare = total - self.alphabet
        freq = 1 + self.counts * spare // max(1, self.seen)
        freq[0] += total - int(freq.sum())
        self.freq = freq
        # start and size of each id's part, in one word
        self.parts = ((np.cumsum(freq) - freq).astype(np.uint64) << _WORD) | freq.astype(np.uint64)
        self.of_slot: np.ndarray | None = None

    def slots(self) -> np.ndarray:
        """Decoder: the id of each slot of the order-0 frequencies."""
        if self.of_slot is None:
            self.of_slot = np.repeat(np.arange(self.alphabet, dtype=np.uint32), self.freq)
        return self.of_slot

    def _weights(self) -> None:
        share = self.hits[:, :2] / self.hits.sum(axis=1, keepdims=True)
        share = np.maximum(1, (share * ((1 << SHARE_BITS) - 8)).astype(np.uint64))
        # by context: where the parts of order 2, order 1 and order 0 begin, and the end
        edges = np.zeros((32, 4), dtype=np.uint64)
        edges[:, 1] = share[:, 0]
        edges[:, 2] = share[:, 0] + share[:, 1]
        edges[:, 3] = 1 << SHARE_BITS
        self.edges = edges.reshape(-1)
        self.widths = np.diff(self.edges, append=self.edges[-1:])

    def predict(self) -> None:
        """What follows in each lane. Places in tables are of numpy's own index
        type, for which ``take`` copies nothing."""
        at2 = (self.last2 * np.uint32(0x9E3779B1) + self.last1 * np.uint32(0x85EBCA6B)) >> np.uint32(32 - ORDER2_BITS)
        self.at2, self.at1 = at2.astype(np.intp), self.last1.astype(np.intp)
        self.entry2 = self.after2.take(self.at2)
        self.entry1 = self.after1.take(self.at1)
        self.id2 = self.entry2 >> np.uint32(2)
        self.id1 = self.entry1 >> np.uint32(2)
        context = ((self.entry2 & np.uint32(3)) << np.uint32(3)) | ((self.entry1 & np.uint32(3)) << np.uint32(1)) | (
            self.id1 == self.id2
        )
        self.context = context.astype(np.intp)

    def part(self, hit2: np.ndarray, hit1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and width of the parts that were hit, and which lanes hit that of order 0."""
        missed = ~(hit2 | hit1)
        at = (self.context << 2) + ~hit2 + missed
        return self.edges.take(at), self.widths.take(at), missed

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        fresh = ids << np.uint32(2)
        for table, at, entry, hit in ((self.after2, self.at2, self.entry2, hit2), (self.after1, self.at1, self.entry1, hit1)):
            sure = entry & np.uint32(3)
            kept = np.where(sure > 0, entry - np.uint32(1), fresh)
            table[at] = np.where(hit, entry + (sure < 3), kept)
        self.turn += 1
        if self.turn % 4 == 1:
            which = np.where(hit2, 0, np.where(hit1, 1, 2))
            self.hits += np.bincount(self.context * 3 + which, minlength=96).reshape(32, 3)
            self._weights()
        self.last2, self.last1 = self.last1, ids
        self.seen += len(ids)
        self.pending.append(ids)
        if self.seen >= self.due:
            self._frequencies()
            self.due = self.seen + self.seen // 4 + 1


def _lanes(n: int) -> tuple[int, int]:
    lanes = max(1, min(MOST_LANES, n // LANE_IDS))
    return lanes, -(-n // lanes)


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[int, bytes]:
    """The coded ids: number of lanes, then words per lane and the words."""
    n = len(ids)
    if n == 0:
        return 0, b""
    lanes, steps = _lanes(n)
    padded = np.zeros(lanes * steps, dtype=np.uint32)
    padded[:n] = ids
    by_step = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model = Model(alphabet, lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, _ALL, dtype=np.uint64)
    room = steps + 2
    words = np.zeros(lanes * room, dtype=np.uint32)
    put = np.arange(lanes, dtype=np.int64) * room
    share, deep = np.uint64(SHARE_BITS), np.uint64(model.bits)
    for step in range(steps):
        model.predict()
        x = by_step[step]
        hit2, hit1 = model.id2 == x, model.id1 == x
        begin, width, missed = model.part(hit2, hit1)
        unit = span >> share
        low += unit * begin
        span = unit * width
        _narrow(low, span, span >> deep, model.parts.take(x.astype(np.intp)), missed)
        model.learn(x, hit2, hit1)
        out = np.flatnonzero(span < _LEAST)
        if len(out):
            word, low[out], span[out] = _shift(low.take(out), span.take(out))
            at = put.take(out)
            words[at] = word
            put[out] = at + 1
    # a multiple of 2^32 lies in the last interval: one word names it
    words[put] = (low + _MASK) >> _WORD
    sizes = (put + 1 - np.arange(lanes) * room).astype("<u4")
    used = np.arange(room)[None, :] < sizes[:, None]
    return lanes, sizes.tobytes() + words.reshape(lanes, room)[used].astype("<u4").tobytes()


def _narrow(low: np.ndarray, span: np.ndarray, unit: np.ndarray, part: np.ndarray, missed: np.ndarray) -> None:
    """The part of its id, in the lanes that hit the part of order 0."""
    low += np.where(missed, unit * (part >> _WORD), np.uint64(0))
    np.copyto(span, unit * (part & _MASK), where=missed)


def _shift(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word to emit, and low and range after it."""
    crosses = ((low ^ (low + span)) >> _WORD) > 0
    span = np.where(crosses, (~low + np.uint64(1)) & _MASK, span)
    return low >> _WORD, low << _WORD, span << _WORD


def decode_ids(coded: bytes, n: int, lanes: int, alphabet: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, dtype=np.uint32)
    steps = -(-n // lanes)
    sizes = np.frombuffer(coded, dtype="<u4", count=lanes).astype(np.int64)
    words = np.concatenate((np.frombuffer(coded, dtype="<u4", offset=4 * lanes), np.zeros(2, dtype="<u4"))).astype(np.uint64)
    stop = np.cumsum(sizes)
    get = stop - sizes
    model = Model(alphabet, lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, _ALL, dtype=np.uint64)
    code = (words[get] << _WORD) | np.where(sizes > 1, words[get + 1], np.uint64(0))
    get += 2
    share, deep = np.uint64(SHARE_BITS), np.uint64(model.bits)
    most = np.uint64((1 << model.bits) - 1)
    by_step = np.empty((steps, lanes), dtype=np.uint32)
    for step in range(steps):
        model.predict()
        unit = span >> share
        above, at = code - low, model.context << 2
        in2, in12 = above < unit * model.edges.take(at + 1), above < unit * model.edges.take(at + 2)
        begin, width, missed = model.part(in2, in12)
        low += unit * begin
        span = unit * width
        unit = span >> deep  # not 0: a span from 2^32 on has lost 12 bits, and loses at most 20 for an alphabet up to 2^19
        symbol = model.slots().take(np.minimum((code - low) // unit, most).astype(np.intp))
        _narrow(low, span, unit, model.parts.take(symbol.astype(np.intp)), missed)
        x = np.where(missed, symbol, np.where(in2, model.id2, model.id1))
        by_step[step] = x
        model.learn(x, model.id2 == x, model.id1 == x)
        out = np.flatnonzero(span < _LEAST)
        if len(out):
            _, low[out], span[out] = _shift(low.take(out), span.take(out))
            at = get.take(out)
            word = words.take(np.minimum(at, len(words) - 1))
            code[out] = (code.take(out) << _WORD) | np.where(at < stop.take(out), word, np.uint64(0))
            get[out] = at + 1
    return by_step.T.reshape(-1)[:n]


def write_block(keys: list, ids: list[bytes], alphabet: int) -> bytes:
    """One block of documents: ids are little-endian unsigned 32-bit."""
    lengths = np.array([len(x) // 4 for x in ids], dtype="<u4")
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    if len(flat) and int(flat.max()) >= alphabet:
        raise ValueError("an id is not in the alphabet")
    nulls = np.array([k is None for k in keys], dtype=np.uint8)
    numbers = np.array([0 if k is None else k for k in keys], dtype="<i8")
    meta = zlib.compress(nulls.tobytes() + numbers.tobytes() + lengths.tobytes(), 1)
    lanes, coded = encode_ids(flat, alphabet)
    body = HEAD.pack(MAGIC, VERSION, 0, 0, len(keys), len(flat), alphabet, lanes, len(meta)) + meta + coded
    return body + struct.pack("<I", zlib.crc32(body))


def read_block(block: bytes) -> tuple[list, list[np.ndarray]]:
    """The document ids and token ids of a block; its checksum is verified."""
    body, (crc,) = block[:-4], struct.unpack("<I", block[-4:])
    if zlib.crc32(body) != crc:
        raise ValueError("block checksum does not match")
    magic, version, _, _, docs, n, alphabet, lanes, size = HEAD.unpack_from(body)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of this format")
    meta = zlib.decompress(body[HEAD.size : HEAD.size + size])
    nulls = np.frombuffer(meta, dtype=np.uint8, count=docs)
    numbers = np.frombuffer(meta, dtype="<i8", count=docs, offset=docs)
    lengths = np.frombuffer(meta, dtype="<u4", count=docs, offset=9 * docs)
    flat = decode_ids(body[HEAD.size + size :], n, lanes, alphabet).astype("<u4")
    keys = [None if null else k for null, k in zip(nulls.tolist(), numbers.tolist())]
    return keys, np.split(flat, np.cumsum(lengths.astype(np.int64))[:-1]) if docs else []


def _together(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """The ids and texts of some batches: as many characters as are encoded together."""
    keys: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        keys += [None if gone else int(key) for key, gone in zip(batch["key"].tolist(), batch["key"].isna().tolist())]
        more = texts_of(batch["text"])
        texts += more
        size += sum(map(len, more))
        if size >= AT_ONCE:
            yield keys, texts
            keys, texts, size = [], [], 0
    yield keys, texts


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    alphabet: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of all documents in ascending id order: rows of (part,
    block, docs, ids, payload), ordered by part and block. Spark's writer
    commits whole files, so a lost executor leaves no half block."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, block = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[bytes] = []
        size = 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame(
                [(part, block, len(keys), size, write_block(keys, held, alphabet))], columns=["part", "block", "docs", "ids", "payload"]
            )

        for some, texts in _together(batches):
            for key, x in zip(some, encoder(vocabulary).encode(texts)):
                keys.append(key)
                held.append(x + end)
                size += len(x) // 4 + 1
                if size >= block_ids:
                    yield flush()
                    keys, held, size, block = [], [], 0, block + 1
        if keys:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    # the hash splits a key that repeats very often, and orders its rows
    dealt = rows.withColumn("spread", F.xxhash64("text")).repartitionByRange("key", "spread").sortWithinPartitions("key", "spread")
    blocks = dealt.select("key", "text").mapInPandas(work, "part int, block int, docs long, ids long, payload binary")
    blocks.write.parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """The documents of a written table in order of ``start``: id, ``start``
    (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of the
    decoded ids) and, unless left out, ``ids``, both as little-endian unsigned
    32-bit integers."""
    blocks = spark.read.schema("part int, block int, docs long, ids long, payload binary").parquet(path)
    extra = ", ids binary" if with_ids else ""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, block, payload in zip(batch["part"], batch["block"], batch["payload"]):
                keys, ids = read_block(payload)
                n = np.array([len(x) for x in ids], dtype=np.int64)
                raw = [x.tobytes() for x in ids]
                out = {
                    "key": pd.array(keys, dtype="Int64"), "part": part, "block": block, "at": np.cumsum(n) - n, "n": n,
                    "crc": np.array([zlib.crc32(x) for x in raw], dtype=np.int64),
                }
                yield pd.DataFrame(out | ({"ids": raw} if with_ids else {}))

    decoded = blocks.select("part", "block", "payload").mapInPandas(
        work, "key long, part int, block int, at long, n long, crc long" + extra
    )
    # ids before each block: sums per part (one row a part), then within a part
    sizes = blocks.select("part", "block", F.col("ids").alias("size"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    parts = parts.select("part", F.coalesce(F.sum("size").over(before(Window.orderBy("part"))), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum("size").over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0))
    bases = sizes.select("part", "block", within.alias("within")).join(parts, "part")
    bases = bases.select("part", "block", (F.col("within") + F.col("base")).alias("base"))
    return decoded.join(bases, ["part", "block"]).select(
        F.col("key").alias(id_col), (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"), *(["ids"] if with_ids else []),
    )
